import random

import numpy as np
from brute import sha, table
from tokenizers import Tokenizer

from tidemark.llm.bpe import Codec, default_path, encoded


def brute(rows):
    tok = Tokenizer.from_file(default_path())
    out = {}
    for d, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        out[d] = (len(ids), sha(np.array(ids, "<u4").tobytes()), sha(tok.decode(ids, skip_special_tokens=False)))
    return out


def got(df):
    return {r.key: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in encoded(df, with_ids=False).collect()}


def corpus(seed):
    rng = random.Random(seed)
    odd = ["a", "it's", "  ", "\n\n", "é", "日本語", "<|endoftext|>", "don't 'LL", " \t x", "😀", "123", "\x00", "é", "\u0085", "​"]
    base = ["".join(rng.choice(["word ", "the ", "of, ", "x", "\n", " é", "123 "]) for _ in range(3000)) for _ in range(4)]
    return [(i * 3, "".join(rng.choice([rng.choice(base)[:rng.randint(0, 9000)],
                                        "".join(rng.choice(odd) for _ in range(rng.randint(0, 200)))])
                            for _ in range(rng.randint(0, 4)))) for i in range(80)]


def test_matches_the_library(spark):
    rows = corpus(1) + [(1000, None), (1001, ""), (1002, "b" * 20000), (1003, "日本" * 5000)]
    assert got(table(spark, rows)) == brute(rows)


def test_round_trip(spark):
    rows = corpus(2)[:20]
    tok = Tokenizer.from_file(default_path())
    texts = dict(rows)
    for r in encoded(table(spark, rows)).collect():
        assert tok.decode(r.ids, skip_special_tokens=False) == texts[r.key]


def test_repeated_rows_and_ids(spark):
    a, b = "some words here " * 500, "other text there " * 400
    rows = [(1, a), (1, a), (1, b), (None, a), (2, a + b)]
    one = brute([(0, a), (1, b), (2, a + b)])
    out = sorted((r.key, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in encoded(table(spark, rows), with_ids=False).collect())
    want = sorted([(-2 ** 63, *one[0]), (1, *one[0]), (1, *one[0]), (1, *one[1]), (2, *one[2])])
    assert out == want
    assert encoded(table(spark, [])).count() == 0


def test_fast_path_agrees_on_its_characters():
    with open(default_path(), encoding="utf-8") as f:
        c = Codec(f.read())
    rng = random.Random(5)
    plain = [chr(i) for i in [9, 10, 13, *range(0x20, 0x7F), *range(0xC0, 0x180)]]
    for _ in range(400):
        t = "".join(rng.choice(plain) for _ in range(rng.randint(0, 60)))
        assert c.fast.encode_ordinary(t) == c.exact.encode(t, add_special_tokens=False).ids
