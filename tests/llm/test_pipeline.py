import hashlib
import re
from collections import Counter

import numpy as np
from brute import near_components, sha, table
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from tidemark.llm import language_id, mixing
from tidemark.llm.bpe import default_path
from tidemark.llm.common import saved

SF = "/root/testdata/sf0.001"


def test_registered():
    names = list(__spark_entry__.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "simhash_near_dedup", "mixing", "bpe"]


def test_matches_brute_force(spark):
    """Every stage's decisions from plain code, except the learned language and
    the random copies, which are the operators' own and tested by themselves."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    said = {r.doc_id: r for r in language_id.predict(docs, language_id.train(docs)).collect()}
    left = [d for d in sorted(rows) if said[d].lang_pred != "und" and said[d].score > 0]
    first = {}
    for d in left:
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", rows[d].text), d)
    left = sorted(first.values())
    component = near_components([(d, rows[d].text) for d in left])
    left = [d for d in left if component[d][1] == d]
    copies = {r.doc_id: r.copies for r in mixing.mix(docs.filter(docs.doc_id.isin(left))).collect()}
    tok, want = Tokenizer.from_file(default_path()), Counter()
    for d in left:
        ids = tok.encode(rows[d].text, add_special_tokens=False).ids
        row = (d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), sha(rows[d].text))
        if copies[d]:
            want[row] = copies[d]
    assert Counter(tuple(r) for r in corpus_pipeline.run(spark, SF).collect()) == want


COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
ODD = [(None, None, None, None, None), (1, "", "en", "a", 0), (2, None, None, None, None), (3, "the cat and the dog", "en", "a", 5),
       (3, "the cat and the dog", "en", "a", 5), (4, "le chien et le chat", "fr", None, None), (None, "le chien", None, "b", 1),
       (5, "12 34", "en", "b", 5), (6, "the dog " * 30000, "en", "b", 1), (7, "THE CAT\tand the dog", "en", "c", 2)]


def staged(spark, docs):
    out = []
    for name, stage in corpus_pipeline.STAGES:
        docs = saved(stage(spark, docs, SF), name)
        out.append(docs)
    return out


def test_stages_on_odd_rows(spark):
    """Nulls everywhere, repeated rows, a long text and clashing column names."""
    docs = table(spark, ODD, COLUMNS)
    out = staged(spark, docs)
    assert all(d.columns == docs.columns for d in out[:-1])
    texts = [sorted(r.text for r in d.collect()) for d in out[:3]]
    assert len(texts[0]) == 6 and "12 34" not in texts[0]            # no letter: rejected
    assert len(texts[1]) == 5 and len(texts[2]) == 4                 # copies go, then near copies
    assert out[4].count() == out[3].count()


def test_stages_on_an_empty_table(spark):
    out = staged(spark, table(spark, [], COLUMNS))
    assert [d.count() for d in out] == [0] * 5
