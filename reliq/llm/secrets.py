"""Secret scans: known forms by pattern, others by two character Markov models.

Patterns find assignments, access keys and long hexadecimal runs. Other long runs of key
characters are candidates: a Markov model of random strings (trained on the secrets that the
patterns found) and one of ordinary identifiers (trained on the different words of a bounded sample
of texts, with the secrets cut out) are compared, and a run whose log-likelihood ratio favours the
first clearly is a secret too. Words and runs are taken apart at ``_ - / + =``, which say nothing;
no run is ever judged by a model that has learnt from it, as words are shorter than runs.

Everything is built-in column functions. Texts are known by a 128-bit hash, so copies are
scanned alike and counted once in the models.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reliq.llm.text import key128, small_side, stored, whole_text

# The forms of known secrets.
ASSIGN = "(?i:password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]{16,}"
#: Runs that the models judge.
RUN = "[A-Za-z0-9+/_=-]{16,}"
KINDS = ["assign", "access", "hex", "markov"]
MARKOV = KINDS.index("markov")
PATTERNS = [ASSIGN, ACCESS, HEX, RUN]
#: Least lengths: of an assignment's value, and of whole matches.
VALUE_LENGTH, ACCESS_LENGTH = 12, 18

#: Characters that the models know, by class; all others only part words.
CLASSES = {"lower": "abcdefghijklmnopqrstuvwxyz", "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": "0123456789"}
ALPHABET = "".join(CLASSES.values())
SEPARATORS = "[+/_=-]+"
#: Texts (about) whose words train the model of identifiers; words as long as runs are no samples.
SAMPLE_TEXTS = 2_000
WORD = "(?<![A-Za-z0-9+/_=-])([A-Za-z0-9+/_=-]{4,15})(?![A-Za-z0-9+/_=-])"
#: Weights of the even distribution: of classes after a class, and of characters within one.
CLASS_PRIOR, CHARACTER_PRIOR = 1.0, 10.0
#: A run is a secret from this log-likelihood ratio on, in all and for each of its characters.
LEAST_RATIO, LEAST_MEAN_RATIO = 20.0, 1.5
BROADCAST_ROWS = 500_000
TEXT = ["h1", "h2"]


def _matches(text: Column, kind: int) -> Column:
    """All matches of a kind as ``kind, i, gap, width, value``: the gap is what lies before each.

    Matches are leftmost and do not overlap; what lies between them is what a split leaves, so each
    text is read once to look for any match, and only those with one are read again. Lengths are
    in code points.
    """
    pattern = PATTERNS[kind]
    gaps, found = F.split(text, pattern), F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))

    def row(x: Column, i: Column) -> Column:
        value = F.regexp_extract(x["m"], pattern, 1) if pattern == ASSIGN else x["m"]
        return F.struct(
            F.lit(kind).alias("kind"),
            i.cast("int").alias("i"),
            F.length(x["g"]).alias("gap"),
            F.length(x["m"]).alias("width"),
            value.alias("value"),
        )

    rows = F.transform(F.arrays_zip(gaps.alias("g"), found.alias("m")), row)
    return F.when(text.rlike(pattern), F.filter(rows, lambda row: row["width"] > 0))


def found_spans(docs: DataFrame) -> DataFrame:
    """Matches of all patterns, once per distinct text: ``h1, h2, kind, start, end, value``."""
    text = whole_text(docs)
    h1, h2 = key128(text)
    read = docs.select(h1.alias("h1"), h2.alias("h2"), text.alias("text"))
    none = F.array().cast("array<struct<kind:int,i:int,gap:int,width:int,value:string>>")
    kinds = [F.coalesce(_matches(F.col("text"), kind), none) for kind in range(len(KINDS))]
    rows = read.select(*TEXT, F.explode(F.concat(*kinds)).alias("m")).select(*TEXT, "m.*")
    once = rows.dropDuplicates([*TEXT, "kind", "i"])
    so_far = Window.partitionBy(*TEXT, "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    placed = once.withColumn("end", F.sum(F.col("gap") + F.col("width")).over(so_far))
    kind, width = F.col("kind"), F.col("width")
    enough = (
        ((kind == 0) & (F.length("value") >= VALUE_LENGTH))
        | ((kind == 1) & (width >= ACCESS_LENGTH))
        | (kind >= 2)
    )
    return placed.filter(enough).select(*TEXT, "kind", (F.col("end") - width).alias("start"), "end", "value")


def character_pairs(strings: DataFrame) -> DataFrame:
    """Each character of the column ``value`` with the one before it (``^`` at the start of a part): ``a``, ``b``."""
    letters = F.split(F.concat(F.lit("^"), F.regexp_replace("value", SEPARATORS, "^")), "")
    kept = F.filter(letters, lambda c: c != "")
    pairs = F.arrays_zip(kept.alias("a"), F.slice(kept, 2, F.length("value")).alias("b"))
    others = [F.col(name) for name in strings.columns if name != "value"]
    exploded = strings.select(*others, F.explode(pairs).alias("p"))
    return exploded.select(*others, "p.a", "p.b").filter(F.col("b").isin(list(ALPHABET)))


def _class(character: Column) -> Column:
    known = F.when(character == "^", "start")
    for name, members in CLASSES.items():
        known = known.when(character.isin(list(members)), name)
    return known


def _logs(pairs: DataFrame, name: str) -> DataFrame:
    """Log probabilities of a character after another, for the whole alphabet.

    The more different characters have followed one, the less its counts are trusted; the rest of the
    trust goes to the class of the next character after the class of this one, and to how
    frequent the next character is within its class.
    """
    grid = (
        pairs.sparkSession.range(1)
        .select(F.explode(F.array(*map(F.lit, "^" + ALPHABET))).alias("a"))
        .select("a", F.explode(F.array(*map(F.lit, ALPHABET))).alias("b"))
        .withColumns({"ca": _class(F.col("a")), "cb": _class(F.col("b"))})
    )
    counts = pairs.groupBy("a", "b").agg(F.count("*").alias("n"))
    full = grid.join(counts, ["a", "b"], "left").fillna({"n": 0})

    # The grid has a few thousand rows, whatever the corpus.
    def total(*keys: str) -> Column:
        return F.sum("n").over(Window.partitionBy(*keys))

    members = F.size(F.collect_set("b").over(Window.partitionBy("cb")))
    next_class = (total("ca", "cb") + CLASS_PRIOR * members / len(ALPHABET)) / (total("ca") + CLASS_PRIOR)
    in_class = (total("b") + CHARACTER_PRIOR / members) / (total("cb") + CHARACTER_PRIOR)
    followers = F.count_if(F.col("n") > 0).over(Window.partitionBy("a")) + 1
    chance = (F.col("n") + followers * next_class * in_class) / (total("a") + followers)
    return full.select("a", "b", F.log(chance).alias(name))


def ratio_table(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``a``, ``b`` and the log ratio of the two models: a few thousand rows, whatever the corpus.

    Without secrets to learn from, the model of random strings is the even one.
    """
    secrets = spans.filter(F.col("kind") < MARKOV).select("value").distinct()
    text = whole_text(docs)
    h1, h2 = key128(text)
    given = docs.select(text.alias("text"), h1.alias("h1"), h2.alias("h2"))
    # Only keys are dealt for the count, and of the texts only those drawn.
    different = given.select(*TEXT).distinct().count()
    text = F.col("text")
    draw = F.pmod(F.xxhash64(text), F.lit(1 << 30)).cast("double") * max(different, 1) < float(SAMPLE_TEXTS << 30)
    bare = text
    for pattern in PATTERNS[:MARKOV]:
        bare = F.regexp_replace(bare, pattern, " ")
    words = given.filter(draw).dropDuplicates(TEXT).select(F.explode(F.regexp_extract_all(bare, F.lit(WORD), F.lit(1))).alias("value"))
    # Words count once each: frequent ones say no more of what others look like.
    words = words.distinct()
    random, plain = _logs(character_pairs(secrets), "r"), _logs(character_pairs(words), "w")
    return random.join(plain, ["a", "b"]).select("a", "b", (F.col("r") - F.col("w")).alias("ratio"))


def judged_runs(spans: DataFrame, ratios: DataFrame) -> DataFrame:
    """Candidate runs apart from all known secrets that the models call random: spans of kind ``markov``."""
    place = Window.partitionBy(*TEXT).orderBy("start", "kind")
    known = F.col("kind") < MARKOV
    reached = F.max(F.when(known, F.col("end"))).over(place.rowsBetween(Window.unboundedPreceding, -1))
    ahead = F.min(F.when(known, F.col("start"))).over(place.rowsBetween(1, Window.unboundedFollowing))
    apart = (F.coalesce(reached, F.lit(0)) <= F.col("start")) & F.coalesce(ahead >= F.col("end"), F.lit(True))
    runs = spans.withColumn("apart", apart).filter((F.col("kind") == MARKOV) & F.col("apart"))
    pairs = character_pairs(runs.select(*TEXT, "start", "end", "value"))
    sums = pairs.join(F.broadcast(ratios), ["a", "b"]).groupBy(*TEXT, "start", "end")
    sums = sums.agg(F.sum("ratio").alias("ratio"), F.count("*").alias("judged"))
    clear = (F.col("ratio") >= LEAST_RATIO) & (F.col("ratio") >= LEAST_MEAN_RATIO * F.col("judged"))
    return sums.filter(clear).select(*TEXT, F.lit(MARKOV).alias("kind"), "start", "end")


def scan(docs: DataFrame) -> DataFrame:
    """Rows ``row`` (the columns of ``docs``) and ``spans``: structs ``start, kind, end`` in order.

    Starts count code points, ends are exclusive; kinds are numbers in the order of ``KINDS``. A
    null text counts as empty and has no spans. Repeated rows get equal spans.
    """
    spans = stored(found_spans(docs), "spans")
    ratios = stored(ratio_table(docs, spans), "ratios")
    known = spans.filter(F.col("kind") < MARKOV).select(*TEXT, "kind", "start", "end")
    every = known.unionByName(judged_runs(spans, ratios))
    held = every.groupBy(*TEXT).agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"))
    h1, h2 = key128(whole_text(docs))
    rows = docs.select(F.struct(*[docs[name] for name in docs.columns]).alias("row"), h1.alias("h1"), h2.alias("h2"))
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    joined = rows.join(small_side(stored(held, "secrets"), BROADCAST_ROWS), TEXT, "left")
    return joined.select("row", F.coalesce("spans", none).alias("spans"))


def written(spans: Column) -> Column:
    """Spans as text: kind:start:end, joined by commas."""
    names = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )
