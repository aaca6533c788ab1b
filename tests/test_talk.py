"""Objects in chatty text, words of overlapping slices, and labels by first sight, against plain Python."""

import json
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from parley.operators import responses, speakers, words


def _slow(text):
    """The first stretch from a brace on that the standard parser takes as an object, one end after the other."""
    for a, c in enumerate(text):
        if c == "{":
            for b in range(a + 1, len(text) + 1):
                if text[b - 1] == "}":
                    try:
                        if isinstance(json.loads(text[a:b], parse_constant=responses._refused), dict):
                            return text[a:b]
                    except ValueError:
                        pass
    return None


_VALUES = st.recursive(st.none() | st.booleans() | st.integers(-9, 9) | st.text('ab"\\{}[]\n`é', max_size=5), lambda v: st.lists(v, max_size=3) | st.dictionaries(st.text('k"}{\\', max_size=3), v, max_size=3), max_leaves=6)


@settings(max_examples=400, deadline=None)
@given(st.text('{}[]" \\a1:,`', max_size=14), _VALUES, st.text('{}[]" \\a`', max_size=8))
def test_first_object_equals_a_slow_parser(before, value, after):
    text = before + json.dumps(value, ensure_ascii=False) + after
    assert responses.first_object(text) == _slow(text)


def test_unwrapping_names_the_first_fault(spark):
    sound = {"choices": [{"finish_reason": "stop", "message": {"content": '```json\n{"a": "}"}\n```'}}], "usage": {"prompt_tokens": 3, "completion_tokens": 4, "total_tokens": 7, "cost": 0.25}}

    def with_(path, value):
        doc = json.loads(json.dumps(sound))
        at = doc
        for p in path[:-1]:
            at = at[p]
        at[path[-1]] = value
        return json.dumps(doc)

    message = ("choices", 0, "message")
    cases = {
        json.dumps(sound): None, "[]": "response", "": "response", "{": "response", "{}": "choices", with_(("choices",), []): "choices", with_(("choices", 0), 4): "choice", with_(("choices", 0, "finish_reason"), "length"): "truncated",
        with_(("choices", 0, "finish_reason"), "content_filter"): "filtered", with_(("choices", 0, "finish_reason"), "tool"): "incomplete", with_(("choices", 0, "finish_reason"), None): None, with_(message, "x"): "message",
        with_((*message, "refusal"), "no"): "refused", with_((*message, "refusal"), ""): None, with_((*message, "content"), None): "missing", with_((*message, "content"), [{"type": "image", "text": "{}"}]): "missing",
        with_((*message, "content"), [{"type": "output_text", "text": '{"b": 1}'}]): None, with_((*message, "content"), {"c": 1}): None, with_((*message, "content"), "none { here"): "not_json",
        with_(("usage", "total_tokens"), -1): "usage", with_(("usage", "cost"), "1"): "usage", with_(("usage",), [1]): "usage", with_(("usage",), None): None, with_(("usage", "prompt_tokens"), True): "usage",
    }
    rows = [(n, text) for n, text in enumerate(cases)] + [(-1, None)]
    got = {r["id"]: r for r in responses.unwrapped(spark.createDataFrame(rows, "id long, response string"), ["id"]).collect()}
    assert {n: got[n]["error"] for n in got} == {n: e for n, e in enumerate(cases.values())} | {-1: "response"}
    assert tuple(got[0])[1:] == ('{"a": "}"}', 3, 4, 7, 0.25, None)
    assert all((r["content"] is None) == (r["error"] is not None) for r in got.values())


def test_each_word_of_overlapping_slices_is_heard_once(spark):
    r, truth, at = random.Random(5), [], 0
    for i in range(300):
        at += r.choice([0, 10, 50, 900])
        truth.append((i, at, at + r.randint(40, 400)))
        at = truth[-1][2]
    slices = []
    for n, a in enumerate(range(0, 300, 7)):
        own = truth[a : a + 7]
        slices.append(("x", n, own[0][1], own[-1][2], max(0, own[0][1] - 700), own[-1][2] + 700))
    decoded = [("x", n, f" w{i} ", (s - start) / 1000, (e - start) / 1000, 0.5) for _, n, _, _, start, end in slices for i, s, e in truth if s < end and e > start]
    assert len(decoded) > 320
    got = words.rebased(
        spark.createDataFrame(decoded, "k string, slice long, word string, start_s double, end_s double, confidence double"),
        spark.createDataFrame(slices, "k string, slice long, core_start long, core_end long, start_ms long, end_ms long"),
        ["k"],
    )
    assert sorted((int(q["word"][1:]), q["start_ms"], q["end_ms"]) for q in got.collect()) == truth


def test_labels_are_numbered_by_first_sight(spark):
    rows = [("a", "z", 5), ("a", "b", 1), ("a", "z", 0), ("a", None, 9), ("b", "q", 3), ("b", "p", 3)]
    got = speakers.first_seen_ids(spark.createDataFrame(rows, "k string, label string, at long"), ["k"], "label", ["at"])
    assert sorted(map(tuple, got.collect()), key=str) == sorted([("a", "z", 0), ("a", "b", 1), ("a", None, 2), ("b", "p", 0), ("b", "q", 1)], key=str)
