"""Language mixtures of more than three languages, and of one language among many relatives of another."""

import numpy as np
import pytest

from parley.llm import langid


def tables(n, rng):
    table = rng.dirichlet(np.full(langid.BUCKETS, 0.05), n) + 1e-7
    return table / table.sum(axis=1, keepdims=True)


def model_of(table):
    return langid.Model(tuple(f"l{k}" for k in range(len(table))), table.astype(np.float32))


@pytest.mark.parametrize("shares", [(0.45, 0.25, 0.2, 0.1), (0.3, 0.25, 0.2, 0.15, 0.1)])
@pytest.mark.parametrize("languages", [5, 12])
def test_every_language_of_a_mixture_is_found(shares, languages):
    rng = np.random.default_rng(4)
    table = tables(languages, rng)
    counts = sum(rng.multinomial(round(2_000 * s), p) for s, p in zip(shares, table))[None].astype(np.float32)
    got, _ = model_of(table).infer(counts)
    assert got[0] == pytest.approx([*shares, *[0] * (languages - len(shares))], abs=0.04)


def test_a_minority_is_found_beside_relatives_of_the_main_language():
    rng = np.random.default_rng(5)
    main, other = tables(2, rng)
    relatives = [0.9 * main + 0.1 * x for x in tables(10, rng)]
    table = np.stack([main, *relatives, other])
    counts = (rng.multinomial(1_700, main) + rng.multinomial(300, other))[None].astype(np.float32)
    got, _ = model_of(table).infer(counts)
    assert got[0, -1] == pytest.approx(0.15, abs=0.03) and got[0, 0] > 0.8
