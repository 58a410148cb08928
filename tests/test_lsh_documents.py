import itertools
import os

import pytest

from heddle.operators import dedupe
from heddle.queries import texts

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the test tables")
def test_lsh_finds_the_exact_pairs_of_documents(spark):
    exact = {(r["id_a"], r["id_b"]) for r in texts.neardup_pairs(spark, SF_DIR).collect()}
    found = {(r["id_a"], r["id_b"]) for r in texts.neardup_pairs_lsh(spark, SF_DIR).collect()}
    assert exact and found <= exact and len(found) >= 0.95 * len(exact)
    print("pairs", len(exact), len(found))


def test_few_pairs_of_a_block_meet_and_parities_bound_what_differs(spark):
    """Under 5 percent of the pairs agree in a band, with nine in ten of the similar ones among them; the bound drops none."""
    scratch = dedupe.Scratch(spark, "test")
    _, sets = dedupe.shingle_sets(texts.blocked_documents(spark, "/root/testdata/sf0.1"), "doc_id", "block", "text")
    known = dedupe._known(sets, scratch)
    pairs = known.groupBy("block").count().selectExpr("sum(count * (count - 1) / 2)").first()[0]
    met = scratch.keep(dedupe.lsh_candidates(known), "met")
    assert met.count() < 0.05 * pairs
    alike = scratch.keep(dedupe.similar_sets(sets, scratch).select("set_a", "set_b"), "alike")
    found = alike.join(met, (alike["set_a"] == met["set_a"]) & (alike["set_b"] == met["set_b"]), "left_semi").count()
    assert found >= 0.9 * alike.count() > 500
    rows = {r["set_id"]: r for r in known.limit(300).collect()}
    for a, b in itertools.combinations(list(rows.values())[:60], 2):
        differ = sum(bin((x ^ y) & (2**64 - 1)).count("1") for x, y in zip(a["parity"], b["parity"]))
        assert differ <= len(set(a["grams"]) ^ set(b["grams"]))


def test_grams_are_the_runs_of_characters():
    for text in ("abc", "aaaa", "Căn hộ 😀😀😀x", "abcabc"):
        runs = {text[i : i + 3] for i in range(len(text) - 2)}
        assert {"".join(chr(int(g) >> s & 0x1FFFFF) for s in (42, 21, 0)) for g in dedupe.char_grams(text)} == runs
