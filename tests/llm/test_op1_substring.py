import random

from brute import substring_dedup, table

from tidemark.llm.substring_dedup import deduplicated


def got(df, **options):
    return {r.key: (r.n_words, r.n_removed, r.kept_sha256) for r in deduplicated(df, **options).collect()}


def corpus(seed, n=120):
    rng = random.Random(seed)
    base = [" ".join(rng.choice(["a", "b", "c", "dd", "é"]) for _ in range(60)) for _ in range(5)]
    rows = []
    for i in range(n):
        parts = [rng.choice([rng.choice(base), "a " * rng.randint(0, 50),
                             " ".join(f"x{rng.randint(0, 99)}" for _ in range(rng.randint(0, 30)))]) for _ in range(rng.randint(0, 4))]
        words = " ".join(parts).split()
        if words and rng.random() < 0.3:
            words[rng.randrange(len(words))] = "zz"
        rows.append((i * 3, "\n".join(words)))
    return rows


def test_matches_brute_force(spark):
    rows = corpus(1) + [(1000, None), (1001, ""), (1002, " \n\t "), (1003, "w" * 5000 + " " + "v " * 3000)]
    assert got(table(spark, rows), with_text=False) == substring_dedup(rows)


def test_other_lengths_and_kept_text(spark):
    rows = corpus(2, 40)
    out = deduplicated(table(spark, rows), length=7, gram=3)
    brute = substring_dedup(rows, 7)
    for r in out.collect():
        assert (r.n_words, r.n_removed, r.kept_sha256) == brute[r.key]
        assert len(r.kept.split()) == r.n_words - r.n_removed


def test_repeated_rows_null_ids_and_empty(spark):
    text = " ".join(map(str, range(40)))
    rows = [(None, text), (5, text), (5, text), (7, text + " tail")]
    out = sorted((r.key, r.n_removed) for r in deduplicated(table(spark, rows), with_text=False).collect())
    # The null id comes first; rows of one id are not earlier than each other.
    assert [n for _, n in out] == [0, 40, 40, 40]
    assert deduplicated(table(spark, [])).count() == 0
