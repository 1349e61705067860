import random
import zlib

import pytest
from brute import merkle_manifest, table

from tidemark.llm import merkle

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def got(df):
    return sorted(map(tuple, df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))


def corpus(n, langs, seed=1):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["web", None, "bücher"]), rng.choices(langs, [5] + [1] * (len(langs) - 1))[0],
             rng.choice([None, i]), rng.choice([None, "", "Ab c", "x" * 5000, f"Text {i}", f"klein {i}"])) for i in range(n)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("n, langs, levels", [
    (700, ["en", None, "de", "", "日本"], 1),          # blocks of 8, several rounds, short last groups
    (70, [f"l{i}" for i in range(30)], 1),              # the tree of languages has blocks of its own
    (300, ["en"], 2), (9, ["a", "b"], 4), (1, ["a"], 4)])
def test_equals_brute_force(spark, n, langs, levels):
    rows = corpus(n, langs)
    assert got(merkle.manifest(table(spark, rows, SCHEMA), merkle.tampered(), levels)) == merkle_manifest(rows)


def test_every_number_of_blocks(spark):
    """Any short last group is answered for: 1 to 75 blocks of 8 leaves in one table."""
    rows = [(i, "s", f"{n:02}", None, str(i)) for n in range(1, 76, 2) for i in range(8 * n - n % 8)]
    assert got(merkle.manifest(table(spark, rows, SCHEMA, clash=False), merkle.tampered(), 1)) == merkle_manifest(rows)


def test_odd_rows(spark):
    """Null and repeated ids, equal rows, nulls in every column; an empty table."""
    rows = [(None, None, None, None, None), (None, None, None, None, "A"), (3, "s", "en", 1, "A"), (3, "s", "en", 1, "A"),
            (3, "s", "en", 2, "B"), (-5, "s", "en", 1, ""), (2 ** 62, "s", None, -1, "é")]
    assert got(merkle.manifest(table(spark, rows, SCHEMA), merkle.tampered(), 1)) == merkle_manifest(rows)
    assert merkle.manifest(table(spark, [], SCHEMA), merkle.tampered()).count() == 0


def test_tampering_shows(spark):
    """A changed text never folds to the root; a text without capitals is not changed."""
    rows = [(i, "s", "en", 1, "Cap" if i % 2 else "low") for i in range(60)]
    res = {r.doc_id: r for r in merkle.manifest(table(spark, rows, SCHEMA), merkle.tampered(), 1, with_proof=True).collect()}
    for i, r in res.items():
        touched = zlib.crc32(str(i).encode()) % 3 == 0 and i % 2 == 1
        assert r.verified == (not touched) and (r.folded_root == r.root) == r.verified
        assert len(r.proof) == len(res[0].proof) or i >= 56
