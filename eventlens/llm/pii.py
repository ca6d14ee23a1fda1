"""Operator 3: personal data by bootstrapped contextual extraction, in
DataFrame functions only.

1. Base entities (e-mail, ip, card, phone) are found by pattern and checked
   (octets, Luhn sum, digit counts).  The patterns are possessive and start at
   the head of a run, so matching is linear in the text.
2. Every base entity is a seed, whatever its characters; every word with digits
   that touches none opens a candidate: itself and the groups of digits after it,
   as far as the separators of the base patterns (space, hyphen, dot, brackets)
   and ``MOST`` digits go.  Both are occurrences of a lexical pattern: the two
   words before them.
3. ``score_patterns`` works on the graph of patterns and instances.  A
   pattern's confidence in a kind is the mean score of its distinct instances;
   an unlabelled instance's score is the noisy-or of its patterns.  Seeds keep
   score 1.  ``ROUNDS`` rounds of two aggregations each.
4. Candidates in a pattern of ``LEAST`` confidence and ``SEEDS`` distinct seeds
   are new entities of the pattern's kind.  Base spans always stay.

Only candidates and spans travel, never texts; a frequent pattern or instance
is pre-aggregated before its shuffle, and its join is one that AQE can split.

Cases.  Null or empty text: no spans.  Rows with equal doc_id and text share
their spans and are each returned; null doc_id is an id like others.  No rows
give no rows.  Extra columns are ignored, or kept by ``redact``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlens.llm.spill import written

# fixed values: kinds in order, with the patterns of their base entities
KINDS = ("email", "ip", "card", "phone")
MATCH = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: cheap tests that every text with such an entity passes
MAYBE = {
    "email": lambda t: t.contains("@"),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){13}"),
    "phone": lambda t: t.contains("+"),
}
ROUNDS, SEEDS, LEAST = 3, 3, 0.8
#: a candidate has so many characters and digits at least
LONG, DIGITS = 5, 3
#: a candidate of several words has so many digits at most, as a base entity has
MOST = 19

SPAN = "struct<start: int, kind_no: int, end: int, kind: string, text: string>"


def _luhn(digits: Column) -> Column:
    n = F.char_length(digits)

    def value(i):
        d = F.substr(digits, n - i + 1, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.transform(F.sequence(F.lit(1), n), value), F.lit(0), lambda a, v: a + v) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        short = lambda p: F.regexp_replace(p, "^0+(?=.)", "")
        return F.forall(F.split(m, r"\."), lambda p: F.when(F.char_length(short(p)) <= 3, short(p).cast("int") <= 255).otherwise(False))
    if kind == "card":
        digits = F.regexp_replace(m, "[ -]", "")
        return F.when(F.char_length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.char_length(F.regexp_replace(m, "[^0-9]", "")).between(10, 15)
    return F.lit(True)


def sum_before(sizes: Column, steps: Column, step: Column, i: Column) -> Column:
    """Sum of the first ``i`` of ``sizes``; ``steps`` has the sums of its runs
    of ``step``, so it takes about 2 * sqrt(n) additions."""
    whole = F.floor(i / step).cast("int")
    add = lambda a: F.aggregate(a, F.lit(0), lambda x, y: x + y)
    return add(F.slice(steps, F.lit(1), whole)) + add(F.slice(sizes, whole * step + 1, i - whole * step))


def _with_steps(df: DataFrame, sizes: str) -> DataFrame:
    """Adds the run length and the run sums that ``sum_before`` needs."""
    df = df.withColumn(f"{sizes}_step", F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(sizes)))).cast("int"))
    runs = F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / F.col(f"{sizes}_step")).cast("int"))
    sums = F.transform(runs, lambda r: F.aggregate(F.slice(sizes, (r * F.col(f"{sizes}_step") + 1).cast("int"), F.col(f"{sizes}_step")),
                                                   F.lit(0), lambda a, b: a + b))
    return df.withColumn(f"{sizes}_steps", F.when(F.size(sizes) > 0, sums).otherwise(F.array().cast("array<int>")))


def _base(df: DataFrame) -> DataFrame:
    """Adds ``base``: the base spans of ``text``, in order."""
    none = F.array().cast("array<string>")
    for no, kind in enumerate(KINDS):
        maybe = MAYBE[kind](F.col("text"))
        df = df.withColumn("hit", F.when(maybe, F.regexp_extract_all("text", F.lit(MATCH[kind]), F.lit(0))).otherwise(none))
        gaps = F.when(F.size("hit") > 0, F.split("text", MATCH[kind], -1)).otherwise(none)
        # the text as gap, match, gap, ...: what lies before a match is a sum of their sizes
        df = df.withColumn("gap", gaps).withColumn("size", F.transform(F.arrays_zip("gap", "hit"), lambda z: F.char_length(z["gap"]) + F.coalesce(F.char_length(z["hit"]), F.lit(0))))
        df = _with_steps(df, "size")

        def span(m, i):
            start = sum_before(F.col("size"), F.col("size_steps"), F.col("size_step"), i) + F.char_length(F.element_at("gap", i + 1))
            return F.struct(start.cast("int").alias("start"), F.lit(no).alias("kind_no"),
                            (start + F.char_length(m)).cast("int").alias("end"), F.lit(kind).alias("kind"), m.alias("text"))

        found = F.filter(F.transform("hit", lambda m, i: F.when(_valid(kind, m), span(m, i))), lambda s: s.isNotNull())
        df = df.withColumn(f"base_{kind}", F.when(F.size("hit") > 0, found).otherwise(F.array().cast(f"array<{SPAN}>")))
    df = df.withColumn("base", F.array_sort(F.concat(*[f"base_{k}" for k in KINDS])))
    return df.drop("hit", "gap", "size", "size_step", "size_steps", *[f"base_{k}" for k in KINDS])


def _with_runs(df: DataFrame) -> DataFrame:
    """Adds ``runs``: the base spans in runs of about sqrt(n), each with its
    lowest start and highest end, so that a word meets few of them."""
    step = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size("base")))).cast("int")
    df = df.withColumn("run", step)
    cut = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("base")), F.col("run")), lambda i: F.slice("base", i, F.col("run")))
    return df.withColumn("runs", F.transform(cut, lambda r: F.struct(
        F.array_min(F.transform(r, lambda s: s["start"])).alias("low"),
        F.array_max(F.transform(r, lambda s: s["end"])).alias("high"), r.alias("spans")))).drop("run")


def _occurrences(df: DataFrame) -> DataFrame:
    """Adds ``seen``: (left, instance, kind, start, end) of the base entities
    and of all other words with digits.  Words keep the white space after them,
    so their sizes add up to places in the text."""
    word = F.when(F.col("text").rlike("[0-9]") | (F.size("base") > 0), F.split("text", r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])", -1))
    df = df.withColumn("word", F.coalesce(word, F.array().cast("array<string>")))
    df = df.withColumn("at", F.transform("word", lambda w: F.char_length(w)))
    df = _with_steps(_with_runs(df), "at")
    bare = lambda w: F.regexp_replace(w, r"[\x20\x09-\x0D]+$", "")
    env = F.struct("word", "at", "at_steps", "at_step", "runs")
    # every step is a transform of its own, so that its values are computed once for each word
    seen = F.get(F.transform(F.array(env), lambda e: _words(e, bare)), F.lit(0))
    return df.withColumn("seen", seen).drop("word", "at", "at_step", "at_steps", "runs")


def _words(e: Column, bare) -> Column:
    """The occurrences of a text's words ``e`` (word, at, at_steps, at_step, runs)."""
    before = lambda i, k: F.when(i >= k, F.lower(bare(F.element_at(e["word"], i - k + 1)))).otherwise(F.lit("^"))

    def touching(o):
        near = F.filter(e["runs"], lambda r: (r["low"] < o["end"]) & (r["high"] > o["start"]))
        return F.filter(F.flatten(F.transform(near, lambda r: r["spans"])), lambda s: (s["start"] < o["end"]) & (s["end"] > o["start"]))

    def seeds(t):
        """The base entities that a word opens; of overlapping ones the first."""
        apart = F.filter(t["own"], lambda s, j: (j == 0) | (F.get(t["own"], j - 1)["end"] <= s["start"]))
        return F.transform(apart, lambda s: seen(t, s["text"], s["kind"], t["o"]["end"]))

    def seen(t, instance, kind, end):
        o = t["o"]
        return F.struct(F.concat_ws(" ", before(o["i"], 2), before(o["i"], 1)).alias("left"), instance.alias("instance"),
                        kind.alias("kind"), o["start"].alias("start"), end.alias("end"))

    def joins(met, t, p):
        """Whether a word of digits goes on from the one before it."""
        last = F.get(met, p - 1)
        between = F.slice(e["word"], last["o"]["i"] + 2, t["o"]["i"] - last["o"]["i"] - 1)
        return F.coalesce(t["goes_on"] & last["opens"] & F.forall(between, lambda w: w.rlike(r"^[().-]++\x20++$")), F.lit(False))

    def more(met, t, p):
        """Words that go on from a word, and the digits of them all."""
        start = F.struct(F.lit(0).alias("n"), t["d"].alias("d"), F.lit(True).alias("on"))

        def add(a, u):
            on = a["on"] & u["joins"] & (a["d"] + u["d"] <= MOST)
            return F.struct((a["n"] + on.cast("int")).alias("n"), F.when(on, a["d"] + u["d"]).otherwise(a["d"]).alias("d"), on.alias("on"))

        return F.when(F.coalesce(F.get(met, p + 1)["joins"], F.lit(False)),
                      F.aggregate(F.slice(met, p + 2, F.lit(MOST)), start, add)).otherwise(start)

    def occurrences(met, t):
        run = F.slice(met, t["p"] + 1, t["more"]["n"] + 1)
        end = F.element_at(run, -1)["o"]["end"]
        plain = (t["n"] == 0) & (end - t["o"]["start"] >= LONG) & (t["more"]["d"] >= DIGITS)
        text = F.array_join(F.transform(run, lambda u: u["o"]["w"]), " ")
        none = F.array().cast("array<struct<left: string, instance: string, kind: string, start: int, end: int>>")
        return F.when(F.size(t["own"]) > 0, seeds(t)).when(plain, F.array(seen(t, text, F.lit(None).cast("string"), end))).otherwise(none)

    once = lambda a, f: F.flatten(F.transform(F.array(a), f))
    # words of base entities have a digit or an @
    digits = F.filter(F.transform(e["word"], lambda w, i: F.when(w.rlike("[0-9@]"), i)), lambda i: i.isNotNull())
    words = F.transform(digits, lambda i: F.struct(
        i.alias("i"), bare(F.element_at(e["word"], i + 1)).alias("w"),
        sum_before(e["at"], e["at_steps"], e["at_step"], i).cast("int").alias("start")))
    words = F.transform(words, lambda o: F.struct(
        o["i"].alias("i"), o["w"].alias("w"), o["start"].alias("start"), (o["start"] + F.char_length(o["w"])).alias("end")))
    met = F.transform(words, lambda o: F.struct(o.alias("o"), touching(o).alias("near")))
    met = F.transform(met, lambda t: F.struct(
        t["o"].alias("o"), F.size(t["near"]).alias("n"), F.filter(t["near"], lambda s: s["start"] >= t["o"]["start"]).alias("own"),
        F.char_length(F.regexp_replace(t["o"]["w"], "[^0-9]", "")).alias("d"),
        ((F.size(t["near"]) == 0) & F.element_at(e["word"], t["o"]["i"] + 1).rlike(r"[0-9][().-]*+\x20++$")).alias("opens"),
        ((F.size(t["near"]) == 0) & t["o"]["w"].rlike(r"^[(.-]*+[0-9][0-9().-]*+[^\p{L}\p{N}]*+$")).alias("goes_on")))
    met = once(met, lambda m: F.transform(m, lambda t, p: F.struct(
        t["o"].alias("o"), t["n"].alias("n"), t["own"].alias("own"), t["d"].alias("d"), joins(m, t, p).alias("joins"))))
    return once(met, lambda m: once(F.transform(m, lambda t, p: F.struct(
        p.alias("p"), t["o"].alias("o"), t["n"].alias("n"), t["own"].alias("own"), more(m, t, p).alias("more"))),
        lambda r: F.flatten(F.transform(r, lambda t: occurrences(m, t)))))


def score_patterns(seen: DataFrame) -> DataFrame:
    """``seen`` (left, instance, kind or null) -> pattern, kind, confidence,
    seeds, for the patterns with a seed."""
    edges = written(seen.groupBy("left", "instance").agg(F.max("kind").alias("kind")), "pattern-edges")
    size = edges.groupBy("left").agg(F.count("*").alias("n"))
    seeds = edges.where("kind is not null").select("left", "instance", "kind", F.lit(1.0).alias("score"))
    open_edges = edges.where("kind is null").select("left", "instance")
    scored = seeds
    for turn in range(ROUNDS):
        patterns = (scored.groupBy("left", "kind").agg(F.sum("score").alias("total"), F.sum((F.col("score") == 1.0).cast("int")).alias("seeds"))
                    .join(size, "left").select("left", "kind", (F.col("total") / F.col("n")).alias("confidence"), "seeds"))
        patterns = written(patterns, "patterns")
        if turn + 1 < ROUNDS:
            # of a pattern with n seeds alike, the share believed in grows with n
            belief = F.col("confidence") * F.least(F.lit(1.0), F.col("seeds") / SEEDS) * 0.95
            hits = open_edges.join(patterns, "left").groupBy("instance", "kind").agg(F.sum(F.log(1 - belief)).alias("doubt"))
            hits = hits.select("instance", "kind", (1 - F.exp("doubt")).alias("score")).where("score >= 0.5")
            scored = seeds.unionByName(open_edges.join(hits, "instance"))
    return patterns


def _keys(docs: DataFrame):
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return text, F.struct(F.col("doc_id").cast("long").alias("id"), F.xxhash64(text).alias("th"))


def entities(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, row (its key), base and spans: arrays
    of (start, kind_no, end, kind) in code points, end exclusive, by start and
    then kind; ``spans`` has the base spans and the discovered ones."""
    text, row = _keys(docs)
    found = _occurrences(_base(docs.select(F.col("doc_id").cast("long").alias("doc_id"), row.alias("row"), text.alias("text")))).drop("text")
    found = written(found, "entities")
    seen = found.select("row", F.explode("seen").alias("o")).select("row", "o.*")
    patterns = score_patterns(seen).where((F.col("confidence") >= LEAST) & (F.col("seeds") >= SEEDS))
    best = patterns.groupBy("left").agg(F.max(F.struct("confidence", "kind")).alias("b")).select("left", F.col("b.kind").alias("as_kind"))
    new = seen.where("kind is null").join(best, "left")
    number = F.array_position(F.array(*map(F.lit, KINDS)), F.col("as_kind")) - 1
    new = new.groupBy("row").agg(F.collect_set(F.struct("start", number.cast("int").alias("kind_no"), "end", F.col("as_kind").alias("kind"))).alias("new"))
    plain = lambda s: F.struct(s["start"].alias("start"), s["kind_no"].alias("kind_no"), s["end"].alias("end"), s["kind"].alias("kind"))
    out = found.withColumn("base", F.transform("base", plain)).join(
        new.select(F.col("row").alias("r"), "new"), F.col("row").eqNullSafe(F.col("r")), "left")
    none = F.array().cast("array<struct<start: int, kind_no: int, end: int, kind: string>>")
    return out.select("doc_id", "row", "base", F.array_sort(F.concat("base", F.coalesce("new", none))).alias("spans"))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every entity in ``text`` replaced by its kind in square
    brackets (overlapping ones by the first one's); all columns stay."""
    text, row = _keys(docs)
    found = entities(docs).where(F.size("spans") > 0).select(F.col("row").alias("__redact_row"), F.col("spans").alias("__redact_spans")).dropDuplicates(["__redact_row"])
    out = docs.withColumn("__redact_key", row).join(found, F.col("__redact_key").eqNullSafe(F.col("__redact_row")), "left")
    # spans that begin inside an earlier one join it
    merged = F.aggregate("__redact_spans", F.array().cast("array<struct<start: int, end: int, kind: string>>"), lambda a, s: F.when(
        (F.size(a) > 0) & (F.element_at(a, -1)["end"] > s["start"]),
        F.concat(F.slice(a, F.lit(1), F.size(a) - 1), F.array(F.struct(
            F.element_at(a, -1)["start"].alias("start"), F.greatest(F.element_at(a, -1)["end"], s["end"]).alias("end"), F.element_at(a, -1)["kind"].alias("kind")))))
        .otherwise(F.concat(a, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))))
    out = out.withColumn("__redact_merged", F.when(F.col("__redact_spans").isNotNull(), merged))
    end = lambda i: F.when(i > 0, F.get("__redact_merged", i - 1)["end"]).otherwise(0)
    part = F.transform("__redact_merged", lambda s, i: F.concat(
        F.substr("text", end(i) + 1, s["start"] - end(i)), F.lit("["), F.upper(s["kind"]), F.lit("]")))
    tail = F.substr("text", F.element_at("__redact_merged", -1)["end"] + 1)
    clean = F.when(F.col("__redact_merged").isNull(), F.col("text")).otherwise(F.concat(F.array_join(part, ""), tail))
    return out.select(*[clean.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns])
