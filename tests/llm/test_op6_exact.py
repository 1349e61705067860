import re
from collections import defaultdict

import pytest
from brute import sha, table

from tidemark.llm.exact_dedup import exact_dedup, kept_documents

ROWS = [(5, "a  b"), (3, "a b"), (9, "a\n\tb"), (4, None), (8, ""), (7, "x"), (10, " "), (11, "a b "), (12, "long " * 20000), (2, "long " * 20000)]


def brute(rows):
    groups, norm = defaultdict(list), {d: re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for d, t in rows}
    for d, n in norm.items():
        groups[n].append(d)
    return {d: (min(groups[n]), len(groups[n]), d == min(groups[n]), sha(n)) for d, n in norm.items()}


def got(df, **options):
    return {r.key: (r.keep_key, r.group_size, r.kept, r.text_sha256) for r in exact_dedup(df, **options).collect()}


@pytest.mark.parametrize("options", [{}, {"files_per_batch": 1}, {"digest_bits": 4}])
def test_matches_brute_force(spark, options):
    """As it is; over several micro-batches; with a digest under which different texts collide."""
    df = table(spark, ROWS).repartition(3)
    assert got(df, **options) == brute(ROWS)


def test_repeated_rows_null_ids_and_empty(spark):
    rows = [(1, "t"), (1, "t"), (1, "u"), (None, "u"), (2, "t"), (3, "alone"), (3, "alone")]
    out = exact_dedup(table(spark, rows)).collect()
    assert len(out) == 7
    by = defaultdict(list)
    for r in out:
        by[r.text_sha256].append(r)
    assert {len(v) for v in by.values()} == {2, 3}
    assert all(sum(r.kept for r in v) == 1 for v in by.values())
    assert all(r.keep_key == -2 ** 63 for r in by[sha("u")])
    kept = kept_documents(table(spark, rows))
    assert kept.columns == table(spark, rows).columns
    assert sorted((r.doc_id is not None, r.text) for r in kept.collect()) == [(False, "u"), (True, "alone"), (True, "t")]
    assert exact_dedup(table(spark, [])).count() == 0
