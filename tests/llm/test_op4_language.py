import numpy as np
from brute import table

from tidemark.llm import language_id as lid

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = lid.op4_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    test = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and len(test) > 150
    assert sum(r.lang == r.lang_pred for r in test) / len(test) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def brute_vector(text, book):
    """Bundle of bound trigrams, one trigram at a time."""
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    out = np.zeros(book.dim)
    for w in words:
        s = f" {w} "
        for a, b, c in zip(s, s[1:], s[2:]):
            out += np.roll(book.letter(ord(a)), 2) * np.roll(book.letter(ord(b)), 1) * book.letter(ord(c))
    return out


def test_prototypes_and_cosines_match_brute_force(spark):
    rows = [(1, "the cat and the hat", "en"), (2, "le chat et l'été", "fr"), (3, "a the of 12 and", "en"), (4, "élan vital", "fr")]
    df = table(spark, rows, "doc_id bigint, text string, lang string")
    learned = lid.learn(df.select("text", "lang"))
    book = lid.Codebook(lid.DIM, lid.SEED)
    for lang in ("en", "fr"):
        want = sum(brute_vector(t, book) for _, t, x in rows if x == lang)
        assert np.allclose(learned[lang], want)
    names, unit, shared = lid.centred(learned)
    for r in lid.predict(df, learned).collect():
        v = brute_vector(dict((d, t) for d, t, _ in rows)[r.doc_id], book)
        v = v / np.linalg.norm(v) - shared
        cosine = unit @ v / np.linalg.norm(v)
        assert r.lang_pred == names[int(np.argmax(cosine))] and abs(r.score - max(0, cosine.max())) < 1e-5


def test_edges(spark):
    rows = [(1, "the cat sat on the mat", "en"), (2, "le chien est là", "fr"), (3, None, "en"), (4, "12 !! 3", "en"), (5, "", None),
            (6, "the cat sat", None), (None, "le chien", None), (6, "the cat sat", None), (7, "the cat " * 20000, None)]
    df = table(spark, rows, "doc_id bigint, text string, lang string")
    learned = lid.learn(df.select("text", "lang"))
    out = {r.doc_id: r for r in lid.predict(df, learned).collect()}
    assert (out[6].lang_pred, out[None].lang_pred, out[7].lang_pred) == ("en", "fr", "en")
    assert all((out[d].lang_pred, out[d].score) == ("und", 0.0) for d in (3, 4, 5))
    assert lid.predict(df, learned).count() == len(rows)
    nothing = lid.learn(table(spark, [], "text string, lang string"))
    assert nothing == {} and {r.lang_pred for r in lid.predict(df, nothing).collect()} == {"und"}
    assert lid.predict(table(spark, [], "doc_id bigint, text string"), learned).count() == 0


def test_filter_keeps_columns_and_clean_documents(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").unionByName(
        spark.createDataFrame([(5000, "12 34", "en", "x", 5)], "doc_id bigint, text string, lang string, source string, n_chars bigint"))
    kept = lid.identified(df)
    assert kept.columns == df.columns and kept.filter("doc_id = 5000").count() == 0 and kept.count() >= 995


def test_junk_goes_and_short_clean_texts_stay(spark):
    """Random consonants, random characters of two scripts that were not learned; every text that was clean stays."""
    import random
    rng = random.Random(11)
    kinds = ["bcdfghjklmnpqrstvwxz", [chr(0x4E00 + i) for i in range(3000)], [chr(0x430 + i) for i in range(32)]]
    junk = [(10_000 + 50 * k + i, " ".join("".join(rng.choice(letters) for _ in range(rng.randint(3, 9))) for _ in range(rng.choice([6, 40, 300]))))
            for k, letters in enumerate(kinds) for i in range(50)]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    words = {lang: docs.filter(f"lang = '{lang}' and n_chars > 2000").select("text").first()[0].split() for lang in ("en", "de", "fr", "es")}
    short = [(20_000 + i, " ".join(w[5 * i:5 * i + 8]), lang) for lang, w in words.items() for i in range(10)]
    more = spark.createDataFrame([(i, t, "en" if i % 2 else None, "x", len(t)) for i, t in junk] + [(i, t, None, "x", len(t)) for i, t, _ in short],
                                 docs.schema)
    kept = {r.doc_id for r in lid.identified(docs.unionByName(more)).select("doc_id").collect()}
    assert not kept & {i for i, _ in junk}
    assert len(kept & {i for i, *_ in short}) >= 0.95 * len({i for i, *_ in short})
    clean = {r.doc_id for r in docs.filter("text rlike '[A-Za-z]{3}'").select("doc_id").collect()}
    assert len(kept & clean) >= 0.99 * len(clean)
