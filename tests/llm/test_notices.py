"""Licence notices that share their line or block with other words."""

from parley.llm import license


def test_notices_inside_lines_blocks_and_comments(spark):
    apache, lgpl = license.TEMPLATES["Apache-2.0-text"], license.MORE_TEMPLATES["LGPL-text"].split()
    wrapped = lambda words, mark: "\n".join(mark + " ".join(words[i : i + 9]) for i in range(0, len(words), 9))
    texts = [
        "Copyright 2024 Acme Ltd. All rights reserved.",
        "We read it twice. This is long prose, released under the MIT License, and more prose follows here.",
        "A heading\nand some words\n" + wrapped(license.TEMPLATES["BSD-text"].split(), "") + "\nwith a tail\nof other lines",
        "/*\n * Copyright 2020 somebody\n *\n" + wrapped(apache.split(), " * ") + "\n *\n" + " * other words of the header, one line after the other\n" * 2 + " * until nothing is left to be said about any of this\n" * 2 + " */",
        "# Copyright somebody\n#\n" + wrapped(lgpl, "# ") + "\n#\n" + "# the rest of the header, which has one line after the other\n" * 2 + "# until nothing is left to be said about any of this file",
        "Pictures are licensed under CC BY-ND 4.0. Words are licensed under CC BY-SA 4.0. All rights reserved for the rest.",
        apache + " Copyright somebody, all rights reserved here",
        "all rights\n\nreserved",
        "He held that all rights were reserved for the king.",
    ]
    rows = license.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    got = {}
    for r in rows:
        got.setdefault(r["doc_id"], set()).add((r["license"], r["dice"], r["n_units"]))
    assert got.pop(3) >= {("Apache-2.0-text", 1.0, 1)}
    assert got == {
        0: {("proprietary", 1.0, 1)},
        1: {("MIT", 1.0, 1)},
        2: {("BSD-text", 1.0, 1)},
        4: {("LGPL-text", 1.0, 1)},
        6: {("Apache-2.0-text", 0.892857, 1), ("proprietary", 1.0, 1)},
        5: {("CC-BY-ND-4.0", 1.0, 1), ("CC-BY-SA-4.0", 1.0, 1), ("proprietary", 1.0, 1)},
    }


def test_every_template_alone_gives_itself_as_in_sql(spark):
    import duckdb

    every = license.TEMPLATES | license.MORE_TEMPLATES
    texts = [*every.values(), *(f"Some words before.\n{t}\nSome words after it." for t in every.values())]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(map(tuple, license.scan(docs).select("dice", "doc_id", "license", "n_units").collect()))
    names = [*every, *every]
    alone = [r for r in got if r[1] < len(every)]
    assert alone == sorted((1.0, i, name, 1) for i, name in enumerate(every))
    assert {(r[1], r[2]) for r in got} == set(enumerate(names))
    c = duckdb.connect()
    c.register("documents", docs.toPandas())
    want = c.sql(license.oracle()).project("dice, doc_id, license, n_units").fetchall()
    assert got == sorted(want)


def test_whole_licences_are_told_apart_with_holders_and_small_changes(spark):
    import duckdb

    texts = {k: f"Copyright (c) 2024 Some Body and others\n\n{t}\n" for k, t in license.WHOLE_TEMPLATES.items()}
    wrapped = {k: "\n\n".join("\n".join(" ".join(p.split()[i : i + 11]) for i in range(0, len(p.split()), 11)) for p in t.split("\n\n")) for k, t in texts.items()}
    names = [*texts, *wrapped]
    docs = spark.createDataFrame(list(enumerate([*texts.values(), *wrapped.values(), "Some words.\n\n" + " ".join(license.WHOLE_TEMPLATES["MIT-whole"].split()[:60])])), "doc_id long, text string")
    rows = license.scan(docs).collect()
    best = {(r["doc_id"], r["license"]) for r in rows if r["license"].endswith("-whole")}
    assert best == set(enumerate(names))
    c = duckdb.connect()
    c.register("documents", docs.toPandas())
    sql = {(r[0], r[1]) for r in c.sql(license.oracle()).project("doc_id, license").fetchall() if r[1].endswith("-whole")}
    assert sql == best
