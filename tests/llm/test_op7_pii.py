import random

from brute import personal, sha, table
from pyspark.sql import functions as F

from tidemark.llm import pii

FRAGMENTS = ["a@b.c", "_x@d.e", ".", "..", "1.2.3.4", "255.256.1.1", "0001.2.3.004", "4111 1111 1111 1111", "4111-1111-1111-1111", "--", " ",
             "  ", "+1 (017) 555-7713", "+", "x", "é", "", "😀", "1", "12", "-", "@", "a.b", "%", "49927398716", "(", ")",
             "+49.30.1234567", "\n", "5500005555555559", "378282246310005", "a@b", "a@b.c.", "a@-.-", "1.2.3.4.5"]
LONG = ["a" * 200000, "1 " * 100000, "a@" + "b." * 50000 + "c", "1" * 200000, "+1" * 5000, "a." * 50000, "@" * 10000]


def got(spark, df, monkeypatch):
    monkeypatch.setattr(pii, "read_documents", lambda *_: df)
    return pii.op7_pii(spark, "").collect()


def test_base_matches_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice(FRAGMENTS) for _ in range(rng.randint(0, 14)))) for i in range(1500)]
    rows += [(5000 + i, t) for i, t in enumerate(LONG)] + [(6000, None), (6001, "")]
    texts = dict(rows)
    for r in got(spark, table(spark, rows), monkeypatch):
        found = personal(texts[r.doc_id] or "")
        base = ",".join(f"{k}:{a}:{b}" for k, a, b in found)
        assert r.base_sha256 == sha(base) and r.spans.startswith(base)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(
            sum(k == kind for k, _, _ in found) for kind in ("email", "ip", "card", "phone"))


def planted():
    """A nickname stands near one address in three texts and nowhere else."""
    rng = random.Random(8)
    words = [f"word{chr(97 + i)}" for i in range(26)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(12))) for i in range(60)]
    return rows + [(100 + i, f"{rng.choice(words)} Zaphod writes from z@hq.org {rng.choice(words)} {i}") for i in range(3)] + [
        (200, "someone else writes from other@hq.org")]


def test_method_adds_revealing_terms(spark, monkeypatch):
    rows = planted()
    out = {r.doc_id: r for r in got(spark, table(spark, rows), monkeypatch)}
    texts = dict(rows)
    for d in (100, 101, 102):
        at = texts[d].index("Zaphod")
        assert f"term:{at}:{at + 6}" in out[d].spans.split(",") and out[d].n_email == 1
    assert all(not out[d].spans for d, _ in rows if d < 100)      # clean documents stay clean
    assert "term" not in out[200].spans
    clean = {r.doc_id: r.text for r in pii.sanitised(table(spark, rows)).collect()}
    assert "Zaphod" not in clean[100] and "[email]" in clean[100] and clean[0] == texts[0]


def test_edges(spark, monkeypatch):
    assert got(spark, table(spark, []), monkeypatch) == []
    rows = [(1, "mail a@b.cc now"), (1, "mail a@b.cc now"), (1, "none"), (None, "x@y.zz")]
    out = got(spark, table(spark, rows), monkeypatch)
    assert sorted((r.doc_id or 0, r.spans) for r in out) == [(0, "email:0:6"), (1, ""), (1, "email:5:11"), (1, "email:5:11")]
    assert sorted(r.text for r in pii.sanitised(table(spark, rows)).collect()) == [
        "[email]", "mail [email] now", "mail [email] now", "none"]


def corpus(extra, n=3000):
    """Texts of common words, and ``extra`` ones."""
    rng = random.Random(4)
    words = [f"word{a}{b}" for a in "abcdefgh" for b in "abcdefgh"]
    return [(i, " ".join(rng.choice(words) for _ in range(12))) for i in range(n)] + [(10000 + i, t) for i, t in enumerate(extra)]


def marked(out, texts, d, word):
    """Whether every occurrence of a word in a document is a term's span."""
    spans = [s.split(":") for s in out[d].spans.split(",") if s.startswith("term:")]
    return all([("term", str(i), str(i + len(word))) in map(tuple, spans)
                for i in range(len(texts[d])) if texts[d].startswith(word, i)])


def test_entity_in_one_text_only(spark, monkeypatch):
    rows = corpus(["wordaa Trillian answers at t@hq.org wordbb"])
    out, texts = {r.doc_id: r for r in got(spark, table(spark, rows), monkeypatch)}, dict(rows)
    assert marked(out, texts, 10000, "Trillian") and not any(marked(out, texts, 10000, w) for w in ("wordaa", "wordbb"))
    assert all(not r.spans for d, r in out.items() if d < 10000)


def test_terms_far_from_the_entity_and_in_other_texts(spark, monkeypatch):
    far = "wordaa " * 40
    rows = corpus([f"Trillian {far} t@hq.org {far} trillian wordbb", "wordcc knows Trillian", "wordcc knows nobody"])
    out, texts = {r.doc_id: r for r in got(spark, table(spark, rows), monkeypatch)}, dict(rows)
    assert all(marked(out, texts, 10000, w) for w in ("Trillian", "trillian")) and marked(out, texts, 10001, "Trillian")
    assert "term" not in out[10002].spans
    clean = {r.doc_id: r.text for r in pii.sanitised(table(spark, rows)).collect()}
    assert not any("trillian" in t.lower() for t in clean.values()) and clean[10002] == texts[10002]


def test_copies_hide_no_term(spark, monkeypatch):
    text = "wordaa Trillian answers at t@hq.org"
    rows = corpus([text, "wordbb Trillian answers at t@hq.org"]) + [(20000 + i, text) for i in range(1000)]
    out, texts = {r.doc_id: r for r in got(spark, table(spark, rows), monkeypatch)}, dict(rows)
    assert len(out) == len(rows) and all(marked(out, texts, d, "Trillian") for d in (10000, 10001, 20000, 20999))


def rare_words(n, entities, seed=5):
    """``n`` texts with words that hardly ever repeat; ``entities`` of them hold an address of their own."""
    rng = random.Random(seed)

    def word():
        return "".join(rng.choice("abcdefghijklmnop") for _ in range(3))

    texts = [" ".join(word() for _ in range(25)) for _ in range(n)]
    return [(i, f"{t} mail u{i}@host{i}.org" if i < entities else t) for i, t in enumerate(texts)]


def test_planted_terms_are_found_and_others_left_alone(spark, monkeypatch):
    rows = rare_words(4000, 200)
    planted = []
    for k in (1, 2, 3, 8):
        for j in range(5):
            name = "planted" + "abcdefgh"[k - 1] + "vwxyz"[j]
            own = [(10000 + 100 * k + 10 * j + i, f"{rows[3000 + 100 * k + 10 * j + i][1]} {name} n{k}{j}@firm.org") for i in range(k)]
            rows += own + ([(20000 + 10 * k + j, f"{rows[2000 + 10 * k + j][1]} {name}")] if k > 1 else [])
            planted += [(d, name) for d, _ in own] + ([(20000 + 10 * k + j, name)] if k > 1 else [])
    out, texts = {r.doc_id: r for r in got(spark, table(spark, rows), monkeypatch)}, dict(rows)
    assert sum(marked(out, texts, d, name) for d, name in planted) >= 0.9 * len(planted)
    named = {d for d, _ in planted}
    unrelated = [d for d in texts if "@" not in texts[d] and d not in named]
    assert sum(bool(out[d].spans) for d in unrelated) <= 0.01 * len(unrelated)


def test_pairs_match_brute_force(spark):
    import math
    rows = rare_words(400, 30) + [(1000 + i, f"zaphod abc z@hq.org y@hq.org {i}") for i in range(3)] + [(2000, "zaphod again")]
    rows += [(3000 + i, "zaphod abc z@hq.org y@hq.org 0") for i in range(9)]      # copies are no evidence
    df = table(spark, rows)
    found = pii.found_spans(df)
    got_rows = {(r.entity, r.term): (r.ratio, r.established) for r in pii.revealing(df, found, generalise=-99.0).collect()}
    texts = {t for _, t in rows}
    terms = {t: {w.lower() for w in pii_terms(t)} for t in texts}
    entities = {t: {f"{k}:{t[a:b]}" for k, a, b in personal(t)} for t in texts}
    where = {}
    for t in texts:
        for e in entities[t]:
            where.setdefault(e, set()).add(t)
    told = {min(e for e in where if where[e] == s) for s in where.values()}
    pairs = {(e, w) for e in told for t in where[e] for w in terms[t]}
    n = len(texts)
    assert set(got_rows) == pairs
    for e, w in pairs:
        n_e, n_t, n_et = len(where[e]), sum(w in terms[t] for t in texts), sum(w in terms[t] for t in where[e])
        ratio = math.log2(n_et * n / ((n_e + 1.5) * (n_t + 1.5))) / math.log2(n / n_e)
        q, p = n_et / n_e, n_t / n
        far = q * math.log(q / p) + ((1 - q) * math.log((1 - q) / (1 - p)) if q < 1 else 0)
        assert abs(got_rows[e, w][0] - ratio) < 1e-9
        assert got_rows[e, w][1] == (n_et >= 0.5 * n_t and len(pairs) * math.exp(-n_e * far) <= 0.01)
    assert got_rows["email:y@hq.org", "zaphod"][1]


def pii_terms(text):
    import regex
    return regex.findall(r"(?<!\p{L})\p{L}{3,}+", text)


def test_many_matches_in_one_text(spark, monkeypatch):
    text = "a@b.cc " * 5000
    [row] = got(spark, table(spark, [(1, text)]), monkeypatch)
    assert row.n_email == 5000 and row.spans.startswith("email:0:6,email:7:13,")


def test_joins_by_hash_shuffle_few_other_texts(spark, monkeypatch):
    """Before a text is shuffled to the tables of its hash, those without an entry there are left out."""
    rows = spark.range(2_000).select(F.unhex(F.md5(F.col("id").cast("string"))).alias("text_hash"), F.col("id").cast("string").alias("text"))
    hashes = rows.where("text % 400 = 3").select(F.col("text_hash").alias("h"), F.lit("a").alias("term"), F.lit("remove").alias("action"))
    met = {r.text for r in pii.named(rows, hashes).collect()}
    assert {"3", "403", "803", "1203", "1603"} <= met and len(met) < 20
    assert {r.text for r in pii.named(rows, hashes, others=True).collect()} == {str(i) for i in range(2_000)} - met
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = pii._marks(rows, hashes)._jdf.queryExecution().executedPlan().toString()
        assert "LeftSemi" in plan and plan.index("SortMergeJoin") < plan.index("BroadcastHashJoin")
        assert plan[plan.index("SortMergeJoin"):plan.index("BroadcastHashJoin")].count("Exchange") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    monkeypatch.setattr(pii, "CODES", 1)                       # all are met: the joins decide
    assert pii.named(rows, hashes).count() == 2_000 and pii.named(rows, hashes, others=True).count() == 0
