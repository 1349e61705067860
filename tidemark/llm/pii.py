"""Personal data: pattern spans and information-theoretic sanitisation.

The base finds e-mail addresses, IP numbers, payment cards and phone numbers;
their values are the *protected entities*. The method asks which other terms
give an entity away: over the corpus, the terms of a text are counted with the
entities in it, and a term's pointwise mutual information with the entity is
held against the entity's own information content,

    PMI(e; t) = log2(n(e,t) N / (n(e) n(t)))     IC(e) = log2(N / n(e)).

A ratio of 1 means that who reads the term knows the entity. Terms at or above
``GENERALISE`` are replaced by a general word, at or above ``REMOVE`` they are
removed. The counts of the entity and of the term are smoothed by ``SMOOTHING`` in
the PMI, so that a pair seen once tells less than one seen often, and in a small
corpus nothing; an entity that stands in one text only has disclosing terms
too. All four numbers count distinct texts, so that copies are no evidence.

In the texts of the entity a disclosing term is marked on the ratio alone. In
all other texts it is marked if the corpus establishes that it belongs to the
entity, which does not get easier as the corpus grows: at least ``SURE`` of the
term's texts hold the entity, and chance makes a pair as close as that in less
than ``LEVEL`` of all corpora. For one pair that probability is at most
exp(-n(e) KL(n(e,t)/n(e) || n(t)/N)) (half the G statistic in the exponent); it is multiplied
by the number of pairs that were judged. A rare word that stands once
beside an address is thus marked there and not elsewhere, unless hardly any
such word was there to be met.

Only DataFrame functions are used. Patterns have no repeated groups, which Java
matches by recursion: the dots or separators such a group would repeat
over are first marked, one character for one character, and a plain class of
characters runs over them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import doc_key, from_key, read_documents, saved, text_of

KINDS = ("email", "ip", "card", "phone")
LEAST_LETTERS = 3    # letters a term has at least
SMOOTHING = 1.5        # texts added to the counts of an entity and of a term
GENERALISE, REMOVE = 0.7, 0.9
SURE = 0.5             # share of a term's texts that hold the entity, to mark it in other texts
LEVEL = 0.01           # expected pairs established by chance, in the whole corpus
STRETCH = 1024         # matches put together at once
CODES = 1 << 21        # different codes of texts, at most broadcast together

MARK = "\ue000"
LABEL, LOCAL = "A-Za-z0-9-", "A-Za-z0-9._%+-"
TERM = rf"(?<!\p{{L}})\p{{L}}{{{LEAST_LETTERS},}}+"
SPAN = "struct<start:bigint,end:bigint,value:string>"
MARKED = "struct<start:bigint,end:bigint,action:string>"


def _located(text: Column, pattern: str, last, row: str) -> Column:
    """All matches from left to right: array of ``row`` (start, end in code points, and
    ``last`` of the match), without those where ``last`` is null.

    The found are appended a stretch at a time, so that a text of many matches
    does not copy its whole list for each.
    """
    pairs = F.arrays_zip(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    none = F.expr(f"cast(array() as array<{row}>)")

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["0"])
        end = start + F.coalesce(F.length(x["1"]), F.lit(0))
        found = F.array(F.struct(start.alias("start"), end.alias("end"), last(x["1"])).cast(row))
        kept = x["1"].isNotNull() & last(x["1"]).isNotNull()
        return F.struct(end.alias("at"), F.when(kept, F.concat(acc["out"], found)).otherwise(acc["out"]).alias("out"))

    def all_of(matches: Column) -> Column:
        def stretch(acc: Column, first: Column) -> Column:
            return F.aggregate(F.slice(matches, first, F.lit(STRETCH)), F.struct(acc["at"].alias("at"), none.alias("out")), step,
                               lambda x: F.struct(x["at"].alias("at"), F.concat(acc["out"], x["out"]).alias("out")))

        return F.aggregate(F.sequence(F.lit(1), F.size(matches), F.lit(STRETCH)),
                           F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("out")), stretch)["out"]

    # As a lambda's variable the matches are found once, not once a stretch.
    return F.transform(F.array(pairs), all_of)[0]


def located(text: Column, pattern: str) -> Column:
    """All matches from left to right: array of (start, end, value), code points."""
    return _located(text, pattern, lambda match: match, SPAN)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    doubled = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(
        i % 2 == 1, F.floor(d.cast("int") * 2 / 10) + d.cast("int") * 2 % 10).otherwise(d.cast("int")))
    return F.aggregate(doubled, F.lit(0).cast("bigint"), lambda a, x: a + x) % 10 == 0


def _only(when: Column, spans: Column) -> Column:
    return F.when(when, spans).otherwise(F.expr(f"cast(array() as array<{SPAN}>)"))


def base_spans(text: Column) -> dict[str, Column]:
    """Spans of each kind, leftmost and not overlapping within the kind."""
    safe = F.translate(text, MARK, "\x01")   # an own marker in the text matches nothing
    dotted = F.regexp_replace(safe, rf"(?<=[{LABEL}])\.(?=[{LABEL}])", MARK)
    email = located(dotted, rf"(?:(?<![{MARK}{LOCAL}])|\G)[{MARK}{LOCAL}]++@[{LABEL}]++{MARK}[{MARK}{LABEL}]++")
    ip = located(safe, r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
    joined = F.regexp_replace(safe, r"(?<=[0-9])[ -](?=[0-9])", MARK)
    card = located(joined, rf"(?<![0-9{MARK}])[0-9][0-9{MARK}]{{12,}}+")
    phone = located(safe, r"\+[0-9][ ().0-9-]+[0-9]")

    def small(part: Column) -> Column:
        plain = F.ltrim(part, F.lit("0"))
        return (F.length(plain) == 0) | ((F.length(plain) <= 3) & (F.lpad(plain, 3, "0") <= "255"))

    def is_card(s: Column) -> Column:
        d = _digits(s["value"])
        return F.length(d).between(13, 19) & _luhn(d)

    return {
        "email": _only(F.contains(text, F.lit("@")), F.transform(email, lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), F.lower(F.translate(s["value"], MARK, ".")).alias("value")))),
        "ip": _only(text.rlike(r"[0-9]\.[0-9]"),
                    F.filter(ip, lambda s: F.forall(F.split(s["value"], r"\."), small))),
        "card": _only(text.rlike(r"[0-9](?:[ -]?[0-9]){12}"), F.transform(F.filter(card, is_card), lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), _digits(s["value"]).alias("value")))),
        "phone": _only(F.contains(text, F.lit("+")), F.transform(
            F.filter(phone, lambda s: F.length(_digits(s["value"])).between(9, 15)), lambda s: F.struct(
                s["start"].alias("start"), s["end"].alias("end"), _digits(s["value"]).alias("value")))),
    }


def text_terms(text: str = "text") -> Column:
    """The distinct terms of the text, in small letters."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text_of(text), F.lit(TERM), F.lit(0)), F.lower))


def text_id() -> Column:
    """What names a text: 128 bits, of many texts no two alike; null counts as empty."""
    return F.unhex(F.md5(text_of()))


def _code(col: str) -> Column:
    return F.pmod(F.xxhash64(col), F.lit(CODES))


def named(rows: DataFrame, hashes: DataFrame, others: bool = False) -> DataFrame:
    """The ``rows`` that may have a text_hash of ``hashes`` (h), so that a join shuffles few other
    texts: all that have one, and those of the same code. With ``others`` the rest of the rows.

    Codes are few, so they are broadcast whatever the number of hashes.
    """
    codes = hashes.select(_code("h").alias("code")).distinct()
    return rows.join(F.broadcast(codes), _code("text_hash") == F.col("code"), "left_anti" if others else "left_semi")


def found_spans(docs: DataFrame) -> DataFrame:
    """One row a document: key, text_hash, ``spans`` with the kind of each base
    span, in the order of the kinds, then of their starts; ``held`` is the text
    if it has spans."""
    rows = docs.select(doc_key().alias("key"), text_id().alias("text_hash"), text_of().alias("text"))
    for kind, spans in base_spans(F.col("text")).items():
        rows = rows.withColumn(kind, spans)

    def tagged(kind: str) -> Column:
        return F.transform(kind, lambda s: F.struct(
            F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
            F.concat(F.lit(f"{kind}:"), s["value"]).alias("entity")))

    rows = rows.withColumn("spans", F.concat(*[tagged(kind) for kind in KINDS]))
    return rows.select("key", "text_hash", "spans", F.when(F.size("spans") > 0, F.col("text")).alias("held"))


def term_counts(docs: DataFrame, found: DataFrame) -> tuple[DataFrame, int]:
    """(t, n_t) of every term, and the number of texts; both of distinct texts."""
    # A text's m copies count as one: each has 1/m of it.
    hashes = found.groupBy(F.col("text_hash").alias("h")).agg(F.count("*").alias("m"))
    copied = saved(hashes.filter(F.col("m") > 1), "pii-copies")
    rows = docs.select(text_id().alias("text_hash"), text_of().alias("text"))
    once = named(rows, copied, others=True).select("text", F.lit(1.0).alias("part"))
    part = once.unionByName(named(rows, copied).join(copied, F.col("text_hash") == F.col("h"), "left").select(
        "text", (1 / F.coalesce("m", F.lit(1))).alias("part")))
    counts = (part.select("part", F.explode(text_terms()).alias("t"))
              .groupBy("t").agg(F.round(F.sum("part")).alias("n_t")))
    return counts, hashes.count()


def told_entities(texts: DataFrame) -> DataFrame:
    """(text_hash, entity, n_e) of the entities that are judged. Entities that
    stand in the same texts have the same terms and ratios: the smallest of
    them stands for all."""
    named = texts.select("text_hash", F.explode(F.array_distinct("spans.entity")).alias("entity"))
    sets = named.groupBy("entity").agg(F.count("*").alias("n_e"), *[
        F.bit_xor(F.xxhash64(F.lit(i), "text_hash")).alias(f"set_{i}") for i in range(2)])
    told = sets.groupBy("n_e", "set_0", "set_1").agg(F.min("entity").alias("e"))
    return named.join(told, F.col("entity") == F.col("e")).select("text_hash", "entity", "n_e")


def revealing(docs: DataFrame, found: DataFrame, generalise: float = GENERALISE, remove: float = REMOVE,
              smoothing: float = SMOOTHING, sure: float = SURE, level: float = LEVEL) -> DataFrame:
    """(entity, term, ratio, action, established) of the terms that disclose an entity of
    ``told_entities``; ``established`` if the term is marked in other texts too."""
    texts = found.filter(F.size("spans") > 0).dropDuplicates(["text_hash"])
    terms = texts.select(F.col("text_hash").alias("h"), F.explode(text_terms("held")).alias("term"))
    pairs = saved(told_entities(texts).join(terms, F.col("text_hash") == F.col("h"))
                  .groupBy("entity", "n_e", "term").agg(F.count("*").alias("n_et")), "pii-pairs")
    counts, total = term_counts(docs, found)
    met = pairs.join(counts, F.col("term") == F.col("t"))
    every, judged = F.lit(float(max(total, 1))), F.lit(float(max(pairs.count(), 1)))
    content = F.log2(every / F.col("n_e"))
    chance = (F.col("n_e") + smoothing) * (F.col("n_t") + smoothing)
    ratio = F.when(content > 0, F.log2(F.col("n_et") * every / chance) / content).otherwise(0.0)
    with_term, expected = F.col("n_et") / F.col("n_e"), F.col("n_t") / every
    far = with_term * F.log(with_term / expected) + F.when(
        with_term < 1, (1 - with_term) * F.log((1 - with_term) / (1 - expected))).otherwise(0.0)
    established = (F.col("n_et") >= sure * F.col("n_t")) & (F.log(judged) - F.col("n_e") * far <= F.log(F.lit(level)))
    return (met.select("entity", "term", ratio.alias("ratio"), established.alias("established")).filter(F.col("ratio") >= generalise)
            .withColumn("action", F.when(F.col("ratio") >= remove, "remove").otherwise("generalise")))


def marked(text: Column, act: Column) -> Column:
    """Where the terms of ``act`` (term to action) stand: array of (start, end, action)."""
    return _located(text, TERM, lambda match: F.element_at(act, F.lower(match)), MARKED)


def _marks(texts: DataFrame, acts: DataFrame) -> DataFrame:
    """(text_hash, mark) of every place in ``texts`` (text_hash, text) that ``acts`` (h, term, action) name."""
    maps = acts.groupBy("h").agg(F.map_from_entries(F.collect_list(F.struct("term", "action"))).alias("act"))
    maps = saved(maps, "pii-hits")
    return (named(texts, maps).join(maps, F.col("text_hash") == F.col("h")).select("text_hash", marked(F.col("text"), F.col("act")).alias("marks"))
            .dropDuplicates(["text_hash"]).select("text_hash", F.explode("marks").alias("mark")))


def term_marks(docs: DataFrame, found: DataFrame, **options) -> DataFrame:
    """(h, terms) of each distinct text with marked terms."""
    told = saved(revealing(docs, found, **options), "pii-terms")
    # In the texts of the entity; only those are read.
    texts = found.filter(F.size("spans") > 0).dropDuplicates(["text_hash"]).select("text_hash", "spans", F.col("held").alias("text"))
    own = (texts.select(F.col("text_hash").alias("h"), F.explode(F.array_distinct("spans.entity")).alias("e"))
           .join(told, F.col("e") == F.col("entity")).groupBy("h", "term").agg(F.max("action").alias("action")))
    # In every text: established terms, on the text alone, so that every copy gets the same.
    known = saved(told.filter("established").groupBy(F.col("term").alias("t")).agg(F.max("action").alias("action")), "pii-known")
    rows = docs.select(text_id().alias("text_hash"), text_of().alias("text"))
    other = (rows.select(F.col("text_hash").alias("h"), F.explode(text_terms()).alias("term"))
             .join(known, F.col("term") == F.col("t")).select("h", "term", "action").distinct())
    marks = _marks(texts.select("text_hash", "text"), own).unionByName(_marks(rows, other))
    one = marks.groupBy("text_hash", "mark.start", "mark.end").agg(F.max("mark.action").alias("action"))
    return one.groupBy(F.col("text_hash").alias("h")).agg(
        F.sort_array(F.collect_list(F.struct("start", "end", "action"))).alias("terms"))


def personal_data(docs: DataFrame, **options) -> DataFrame:
    """One row a document: key, text_hash, ``spans`` (kind, start, end, entity)
    and ``terms`` (start, end, action) that the method adds.

    Null text counts as empty and null ids as the smallest; an empty text has
    no spans. Rows that repeat get the same spans each. Where a term discloses
    two entities the stronger action holds. An empty table gives no rows;
    columns beside doc_id and text are not read.
    """
    found = saved(found_spans(docs), "pii-spans")
    terms = saved(term_marks(docs, found, **options), "pii-marks")
    outside = F.filter("terms", lambda t: ~F.exists("spans", lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"])))
    return found.join(terms, F.col("text_hash") == F.col("h"), "left").select("key", "text_hash", "spans", F.coalesce(
        outside, F.expr(f"cast(array() as array<{MARKED}>)")).alias("terms"))


def sanitised(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` with ``text`` sanitised: a base span becomes its
    kind in brackets, a term is generalised to ``[term]`` or removed. Of
    overlapping spans the one that starts first (then the longer) is replaced."""
    plan = personal_data(docs, **options).select(
        F.col("key").alias("k"), F.col("text_hash").alias("h"),
        F.array_sort(F.concat(
            F.transform("spans", lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("end"),
                                                    F.concat(F.lit("["), s["kind"], F.lit("]")).alias("by"))),
            F.transform("terms", lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("end"),
                                                    F.when(s["action"] == "remove", "").otherwise("[term]").alias("by")))
        )).alias("cuts")).dropDuplicates(["k", "h"])
    rows = docs.select(F.struct("*").alias("row"), doc_key().alias("key"), text_id().alias("text_hash"),
                       F.col("text").alias("old"))

    def step(acc: Column, x: Column) -> Column:
        kept = F.substring(F.col("old"), (acc["at"] + 1).cast("int"), (x["start"] - acc["at"]).cast("int"))
        return F.when(x["start"] < acc["at"], acc).otherwise(F.struct(
            (-x["end"]).alias("at"), F.concat(acc["out"], kept, x["by"]).alias("out")))

    done = F.aggregate("cuts", F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out")), step)
    same = (F.col("key") == F.col("k")) & (F.col("text_hash") == F.col("h"))
    met = rows.join(plan, same).withColumn("done", done)
    text = F.when(F.size("cuts") == 0, F.col("old")).otherwise(F.concat(
        "done.out", F.substring(F.col("old"), (F.col("done.at") + 1).cast("int"), F.length("old"))))
    return met.withColumn("row", F.col("row").withField("text", text)).select("row.*")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    rows = personal_data(read_documents(spark, sf_dir))

    def show(kind: Column, s: Column) -> Column:
        return F.concat_ws(":", kind, s["start"].cast("string"), s["end"].cast("string"))

    base = F.transform("spans", lambda s: show(s["kind"], s))
    terms = F.transform("terms", lambda s: show(F.lit("term"), s))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return rows.select(from_key("key").alias("doc_id"), *map(count, KINDS), F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
                       F.array_join(F.concat(base, terms), ",").alias("spans"))
