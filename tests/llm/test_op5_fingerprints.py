import random

from brute import fingerprint, likeness, sha, table

from tidemark.llm import fingerprints as f


def brute(rows):
    def fp(t):
        return fingerprint(t, f.GRAM, f.WINDOW, f.LONGEST)

    def show(x):
        return ",".join(f"{h:010x}:{i}" for i, h in x)

    docs, out = sorted((d, t or "") for d, t in rows), {}
    for i, (d, t) in enumerate(docs):
        after = docs[(i + 1) % len(docs)][1]
        q = len(t) // 4
        edited = t[:len(t) - q] + after[:q]
        out[d] = (len(t), sha(edited), show(fp(t)), show(fp(edited)), likeness(fp(t), fp(edited)), likeness(fp(t), fp(after)))
    return out


def got(spark, df, monkeypatch):
    monkeypatch.setattr(f, "read_documents", lambda *_: df)
    return {r.doc_id: tuple(r)[1:] for r in f.op5_fingerprints(spark, "").collect()}


def test_matches_brute_force(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(i * 7 % 101, " ".join(rng.choice(["a", "bb", "é", "😀", "of", "the\n"]) for _ in range(rng.randint(0, 80)))) for i in range(101)]
    rows += [(500, None), (501, ""), (502, "x" * 3000), (503, " \n "), (504, "one")]
    out = got(spark, table(spark, rows), monkeypatch)
    want = brute(rows)
    for d in want:
        assert out[d][:4] == want[d][:4]
        assert all(abs(a - b) < 1e-12 for a, b in zip(out[d][4:], want[d][4:]))


def test_shared_run_shares_a_hash():
    rng = random.Random(6)
    for _ in range(50):
        run = [f"w{rng.randint(0, 50)}" for _ in range(f.WINDOW + f.GRAM - 1)]
        a, b = ([f"{p}{rng.randint(0, 99)}" for _ in range(rng.randint(0, 30))] + run + [f"{p}x"] for p in "ab")
        x, y = ({h for _, h in fingerprint(" ".join(t), f.GRAM, f.WINDOW, f.LONGEST)} for t in (a, b))
        assert x & y


def test_edges(spark, monkeypatch):
    assert got(spark, table(spark, []), monkeypatch) == {}
    one = got(spark, table(spark, [(3, "a b c d e f g h")]), monkeypatch)[3]
    assert one == brute([(3, "a b c d e f g h")])[3]
    df = table(spark, [(1, "a b c d"), (1, "a b c d"), (2, "x y z u"), (None, "n")])
    monkeypatch.setattr(f, "read_documents", lambda *_: df)
    rows = f.op5_fingerprints(spark, "").collect()
    assert len(rows) == 4 and len({tuple(r) for r in rows}) == 3
