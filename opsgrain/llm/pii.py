"""Operator 13, personal data by candidate gradient boosting (native: DataFrame
functions and JVM MLlib only).

``measure`` finds the base spans of each text inside its own row.  High-recall
generators then propose overlapping candidate spans: every run of up to
``GROUPS`` neighbouring digit groups, with their separators, as card, phone or
ip, and address-like texts around ``@`` or a bracketed "at" as email.  Boosted
trees judge a candidate by its format and context.  They learn from the
candidates that are whole matches of a base pattern, which the base checks
(Luhn sum, part and digit counts) tell right from wrong, and from numbers that
are known to be something else; what defines a check is no feature, so the
score is the share of right ones among candidates of this look.  Per kind the
threshold is calibrated on a fold of texts that the trees have not seen: the
score that a share of ``recall`` of its right candidates reach.  Candidates
that pass their kind's check, reach the threshold and touch no base span are
added, the highest scores first where they overlap.

Base spans are found as the contract's patterns give them, in forms that do
not backtrack: an email's local part starts at the begin of its run or at the
end of the match before, an ip at the begin of a digit run.

Scale: texts are read once and never shuffled; what follows are narrow tables
of candidates.  No group is larger than one text's candidates.

Defined results: a null or empty text has no span; a null doc_id and repeated
rows are rows of their own; candidates of equal score prefer more digit groups,
then the kinds as listed, then the smaller start; a very long text is one row of
the scanning task, in time linear in its length and, for spans of one kind, a
little more; an empty table gives no rows; without right and wrong labelled
candidates nothing is added.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsgrain.llm.common import broadcast_if_small, stored

KINDS = ("email", "ip", "card", "phone")
LOCAL = "[A-Za-z0-9._%+-]"
#: The contract's patterns, without backtracking.
PATTERNS = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+",
    "card": r"[0-9](?:[0-9]|[\x20-](?=[0-9])){8,}+",  # shorter ones cannot pass
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Texts in which a pattern can match at all.
GUARDS = {"email": "@", "ip": "[0-9]\\.[0-9]", "card": "[0-9][ -]?[0-9][ -]?[0-9][ -]?[0-9]", "phone": "\\+[0-9]"}

AT, DOT = r"(?:@|\x20?[(\[{]\x20?at\x20?[)\]}]\x20?)", r"(?:\.|\x20?[(\[{]\x20?dot\x20?[)\]}]\x20?)"
ADDRESS = rf"(?i)(?:\G|(?<![\p{{L}}0-9._%+-]))[\p{{L}}0-9._%+-]++{AT}[\p{{L}}0-9-]++(?:{DOT}[\p{{L}}0-9-]++)++"
ADDRESS_GUARD = r"(?i)@|[(\[{]\x20?at\x20?[)\]}]"
REGION = r"\+?\(?[0-9](?:[0-9]|[\x20()./-]{1,3}+(?=[0-9]))*+"
REGION_GUARD = r"[0-9]"
GROUPS = 8
BEFORE, AFTER = 24, 1
KEYWORDS = r"(?i)(tel|phone|fax|call|mobil|mail|card|visa|ip|host|server|addr)"
CHUNK = 256

FEATURES = [
    *(f"is_{k}" for k in KINDS), "n_chars", "n_digits", "n_groups", "first_len", "last_len", "longest", "shortest", "n_space", "n_dash", "n_dot",
    "n_slash", "n_paren", "letter_before", "letter_after", "keyword",
]


def running(lengths: Column) -> Column:
    """Sums of the elements before each one.  Arrays grow by copies, so this
    goes by chunks, which keeps long arrays near linear."""
    def ahead(values: Column, first: Column) -> Column:
        return F.aggregate(values, F.array(first), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))

    starts = F.sequence(F.lit(1), F.greatest(F.size(lengths), F.lit(1)), F.lit(CHUNK))
    parts = F.transform(starts, lambda i: F.slice(lengths, i, CHUNK))
    offsets = ahead(F.transform(parts, lambda p: F.aggregate(p, F.lit(0), lambda a, x: a + x)), F.lit(0))
    return F.flatten(F.zip_with(parts, F.slice(offsets, 1, F.size(parts)), lambda p, o: F.slice(ahead(p, o), 1, F.size(p))))


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn sum."""
    d = F.reverse(digits)

    def part(i: Column) -> Column:
        x = F.substring(d, i, 1).cast("int")
        return F.when(i % 2 == 1, x).otherwise(2 * x - F.when(x > 4, 9).otherwise(0))

    return F.aggregate(F.transform(F.sequence(F.lit(1), F.length(digits)), part), F.lit(0), lambda a, x: a + x) % 10 == 0


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def passes(kind: str, match: Column) -> Column:
    """The base check of one match."""
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: F.length(F.regexp_replace(p, "^0+", "")) <= 3) & F.forall(
            F.split(match, r"\."), lambda p: F.coalesce(p.try_cast("bigint"), F.lit(0)) <= 255)
    n = F.length(digits_of(match))
    if kind == "card":
        return F.when(n.between(13, 19), luhn(digits_of(match))).otherwise(False)
    return n.between(9, 15) if kind == "phone" else F.lit(True)


def found(df: DataFrame, name: str, pattern: str, guard: str) -> DataFrame:
    """Adds ``name``: the pattern's matches in ``text`` as (start, match),
    and ``<name>_gaps``: what lies around them."""
    may = F.col("text").contains(guard) if guard == "@" else F.col("text").rlike(guard)
    df = df.withColumn("_m", F.when(may, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))))
    df = df.withColumn("_m", F.coalesce("_m", F.array().cast("array<string>")))
    df = df.withColumn("_g", F.when(F.size("_m") > 0, F.split("text", pattern, -1)).otherwise(F.array().cast("array<string>")))
    df = df.withColumn("_l", F.zip_with(F.slice("_g", 1, F.size("_m")), F.col("_m"), lambda g, m: F.length(g) + F.length(m)))
    starts = F.when(F.size("_m") > 0, running(F.col("_l"))).otherwise(F.array().cast("array<int>"))
    own = F.zip_with(F.zip_with(starts, F.slice("_g", 1, F.size("_m")), lambda s, g: s + F.length(g)), F.col("_m"),
                     lambda s, m: F.struct(s.alias("start"), m.alias("match")))
    return df.withColumn(name, own).withColumn(f"{name}_gaps", F.col("_g")).drop("_m", "_g", "_l")


def checked(i: int, kind: str):
    """A match as a span, with its base check."""
    return lambda x: F.struct(F.lit(i + 1).alias("kind"), x["start"].alias("start"), (x["start"] + F.length(x["match"])).alias("end"), passes(kind, x["match"]).alias("valid"))


def measure(documents: DataFrame) -> DataFrame:
    """One narrow row per input row: ``row``, ``doc_id``, ``raw`` (matches of
    the base patterns: kind from 1, start, end, valid), ``groups`` (digit
    groups of numeric regions with what stands around) and ``addresses``."""
    df = documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    for k in KINDS:
        df = found(df, k, PATTERNS[k], GUARDS[k])
    df = found(found(df, "region", REGION, REGION_GUARD), "address", ADDRESS, ADDRESS_GUARD)
    raw = F.concat(*(F.transform(k, checked(i, k)) for i, k in enumerate(KINDS)))

    def around(name: str) -> Column:
        gaps = F.col(f"{name}_gaps")
        numbered = F.transform(name, lambda x, i: F.struct(x["start"].alias("start"), x["match"].alias("match"), F.right(F.element_at(gaps, i + 1), F.lit(BEFORE)).alias("before"),
                                                           F.left(F.element_at(gaps, i + 2), F.lit(AFTER)).alias("after")))
        if name == "address":
            return numbered
        digits = F.regexp_count
        return F.filter(numbered, lambda x: (digits(x["match"], F.lit("[0-9]")) >= 9) | (digits(x["match"], F.lit(r"\.")) >= 3))

    return df.select("row", "doc_id", raw.alias("raw"),
                     around("region").alias("regions"), around("address").alias("addresses"))


def _windows(measured: DataFrame) -> DataFrame:
    """Every run of up to ``GROUPS`` digit groups of one region, as text."""
    region = measured.select("row", F.posexplode("regions").alias("region", "x")).select("row", "region", "x.*")
    groups = region.withColumn("_d", F.regexp_extract_all("match", F.lit("[0-9]+"), F.lit(0))).withColumn("_s", F.split("match", "[0-9]+", -1))
    sizes = F.zip_with(F.slice("_s", 1, F.size("_d")), F.col("_d"), lambda s, d: F.length(s) + F.length(d))
    groups = groups.withColumn("_l", sizes).withColumn("_o", running(F.col("_l"))).withColumn("_n", F.size("_d"))
    cut = F.transform(F.sequence(F.lit(1), F.col("_n")), lambda i: F.struct(
        i.alias("first"),
        (F.col("start") + F.element_at("_o", i) + F.length(F.element_at("_s", i))).alias("at"),
        F.slice("_d", i, GROUPS).alias("d"), F.slice("_s", i, GROUPS + 1).alias("s"),
        F.when(i == 1, F.col("before")).otherwise(F.element_at("_s", i)).alias("before"),
        F.col("before").alias("context"), F.col("after").alias("after")))
    one = groups.select("row", "region", F.explode(cut).alias("g")).select("row", "region", "g.*")
    n = F.col("n")
    w = one.withColumn("n", F.explode(F.sequence(F.lit(1), F.size("d"))))
    w = w.withColumn("total", F.aggregate(F.slice("d", F.lit(1), n), F.lit(0), lambda a, x: a + F.length(x))).where(F.col("total").between(4, 19))
    body = F.concat(F.element_at("d", 1), F.array_join(F.zip_with(F.slice("s", F.lit(2), n - 1), F.slice("d", F.lit(2), n - 1), lambda s, d: F.concat(s, d)), ""))
    return w.withColumn("body", body).withColumn("lead", F.regexp_extract(F.element_at("s", 1), r"\+?\(?$", 0)).withColumn("last", F.col("first") + n - 1).withColumn(
        "next", F.element_at("s", n + 1))


def candidates(measured: DataFrame) -> DataFrame:
    """Overlapping candidate spans of all kinds with their features."""
    w = _windows(measured)
    opens = F.regexp_count("body", F.lit(r"\("))
    closes = F.regexp_count("body", F.lit(r"\)"))
    lead = F.when((closes > opens) & F.col("lead").endswith("("), F.col("lead")).when((closes == opens) & (F.col("lead") == "+"), "+").otherwise("")
    balanced = (opens + F.length(F.regexp_replace(lead, "[^(]", ""))) == closes
    plain = F.regexp_replace("body", "[0-9]", "")
    kinds = F.array_compact(F.array(
        F.when((F.col("n") == 4) & (plain == "...") & (F.array_max(F.transform(F.slice("d", 1, 4), lambda x: F.length(x))) <= 3), F.lit(2)),
        F.when(F.col("total").between(13, 19) & ~plain.rlike("[()]"), F.lit(3)),
        F.when(F.col("total").between(9, 15) & balanced & ~plain.rlike(r"\.\.|/"), F.lit(4)),
    ))
    w = w.withColumn("kinds", kinds).where(F.size("kinds") > 0).withColumn("lead", lead).withColumn("kind", F.explode("kinds"))
    size = F.transform(F.slice("d", F.lit(1), F.col("n")), lambda x: F.length(x))
    prefix = F.when(F.col("kind") == 4, F.col("lead")).otherwise("")
    numbers = w.select(
        "row", "region", "kind", "first", "last", (F.col("at") - F.length(prefix)).alias("start"), (F.col("at") + F.length("body")).alias("end"), F.col("body").alias("match"),
        "before", "context", F.when(F.col("next") == "", F.col("after")).otherwise(F.col("next")).alias("after"),
        F.col("total").alias("n_digits"), F.col("n").alias("n_groups"), size.alias("sizes"))
    mail = measured.select("row", F.posexplode("addresses").alias("region", "x")).select("row", "region", "x.*")
    labels = F.split(F.regexp_extract("match", rf"(?i){AT}(.*)$", 1), rf"(?i){DOT}")
    mail = mail.select(
        "row", (-1 - F.col("region")).alias("region"), F.lit(1).alias("kind"), F.lit(1).alias("first"), F.lit(1).alias("last"), "start",
        (F.col("start") + F.length("match")).alias("end"), F.regexp_replace(F.regexp_replace("match", rf"(?i){AT}", "@"), rf"(?i){DOT}", ".").alias("match"), "before", F.col("before").alias("context"), "after", F.regexp_count("match", F.lit("[0-9]")).alias("n_digits"), F.size(labels).alias("n_groups"),
        F.transform(labels, lambda x: F.length(x)).alias("sizes"))
    c = numbers.unionByName(mail)
    count = {"n_space": r"\x20", "n_dash": "-", "n_dot": r"\.", "n_slash": "/", "n_paren": r"[()]"}
    values = {
        **{f"is_{k}": F.col("kind") == i + 1 for i, k in enumerate(KINDS)},
        "n_chars": F.length("match"), "n_digits": F.col("n_digits"), "n_groups": F.col("n_groups"), "first_len": F.element_at("sizes", 1), "last_len": F.element_at("sizes", -1),
        "longest": F.array_max("sizes"), "shortest": F.array_min("sizes"), **{k: F.regexp_count("match", F.lit(p)) for k, p in count.items()},
        "letter_before": F.col("before").rlike(r"\p{L}$"), "letter_after": F.col("after").rlike(r"^\p{L}"), "keyword": F.col("context").rlike(KEYWORDS),
    }
    right = F.when(F.col("kind") == 2, passes("ip", F.col("match"))).when(F.col("kind") == 3, luhn(digits_of(F.col("match")))).otherwise(True)
    return c.select("row", "region", "kind", "first", "last", "start", "end", right.alias("passes"), *(v.cast("double").alias(k) for k, v in values.items()))


def labelled(found: DataFrame, raw: DataFrame) -> DataFrame:
    """``found`` with ``touches`` (some base span), and ``label``: 1 or 0
    where a candidate is a whole match of its kind's pattern (as the base check
    says), 0 where a phone is a whole card match that failed or lies in a base
    span of another kind, else null."""
    own = raw.withColumnRenamed("valid", "own")
    junk = raw.where("kind = 3 and not valid").select("row", "start", "end", F.lit(True).alias("junk")).distinct()
    c = found.join(own, ["row", "kind", "start", "end"], "left").join(junk, ["row", "start", "end"], "left")
    # base spans before and after each candidate in its text: one ordered pass each way
    base = raw.where("valid").select("row", "start", "end", F.col("kind").alias("base"))
    both = c.unionByName(base, allowMissingColumns=True)
    order = Window.partitionBy("row").orderBy("start", F.col("base").isNull())
    back = Window.partitionBy("row").orderBy(F.col("start").desc(), F.col("base").isNull().desc())
    ends = F.max(F.when(F.col("base").isNotNull(), F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.min(F.when(F.col("base").isNotNull(), F.col("start"))).over(back.rowsBetween(Window.unboundedPreceding, -1))
    both = both.withColumn("_e", ends).withColumn("_s", starts).where("base is null")
    touches = F.coalesce(F.col("_e") > F.col("start"), F.lit(False)) | F.coalesce(F.col("_s") < F.col("end"), F.lit(False))
    label = F.when(F.col("own").isNotNull(), F.col("own")).when((F.col("kind") == 4) & (F.coalesce("junk", F.lit(False)) | (touches & (F.col("n_paren") == 0))), False)
    return both.withColumn("touches", touches).withColumn("label", label.cast("double")).drop("base", "_e", "_s", "own", "junk")


def judged(found: DataFrame, max_train: int, trees: int, depth: int, recall: float, least: float) -> DataFrame:
    """The untouched candidates that pass their check and their kind's
    threshold, with ``score``."""
    known = found.where("label is not null")
    total = known.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0.0)).alias("right")).first()
    if total["right"] in (0.0, float(total["n"])):
        return found.withColumn("score", F.lit(0.0)).limit(0)
    ready = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found)
    share = F.pmod(F.xxhash64("row", "start"), F.lit(1 << 30)) < int(min(1.0, max_train / total["n"]) * (1 << 30))
    held = F.pmod(F.hash("row"), F.lit(4)) == 0
    train = ready.where("label is not null").where(~held & share).select("features", "label")
    if train.select("label").distinct().count() < 2:  # too few texts to set a fold aside
        train, held = ready.where("label is not null").where(share).select("features", "label"), F.lit(True)
    model = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.3, seed=7).fit(train)
    scored = model.transform(ready).withColumn("score", vector_to_array("probability")[1])
    right = scored.where((F.col("label") == 1) & held).groupBy("kind").agg(F.percentile("score", F.lit(1 - recall)).alias("reach"))
    threshold = F.greatest(F.col("reach") - 1e-9, F.lit(least))
    able = scored.where("passes and not touches").drop("features", "rawPrediction", "probability", "prediction")
    return able.join(F.broadcast(right), "kind").where(F.col("score") >= threshold)  # one row a kind


def without_overlaps(chosen: DataFrame) -> DataFrame:
    """Of candidates that share digit groups the highest score, and so on among
    what is left: a round decides all that are best in each of their groups."""
    left = stored(chosen.select("row", "region", "kind", "first", "last", "start", "end", "score"), "pii-chosen")
    key = ["row", "region", "kind", "first", "last"]
    out = None
    while not left.isEmpty():
        rank = F.struct("score", (F.col("last") - F.col("first")).alias("groups"), (-F.col("kind")).alias("kind"), (-F.col("first")).alias("first"))
        cells = left.withColumn("cell", F.explode(F.sequence("first", "last"))).withColumn("rank", rank)
        cells = cells.withColumn("best", F.max("rank").over(Window.partitionBy("row", "region", "cell")) == F.col("rank"))
        won = stored(cells.groupBy(*key).agg(F.first("start").alias("start"), F.first("end").alias("end"), F.bool_and("best").alias("won")), "pii-round")
        out = won.where("won") if out is None else out.unionByName(won.where("won"))
        taken = won.where("won").select("row", "region", F.explode(F.sequence("first", "last")).alias("cell")).distinct()
        hit = left.select(*key, F.explode(F.sequence("first", "last")).alias("cell")).join(taken, ["row", "region", "cell"]).select(*key).distinct()
        left = stored(left.join(hit, key, "left_anti"), "pii-left")
    return out if out is not None else left.withColumn("won", F.lit(True))


def find_personal_data(documents: DataFrame, max_train: int = 50_000, trees: int = 12, depth: int = 4, recall: float = 0.95, least: float = 0.3) -> DataFrame:
    """Every row of ``documents(doc_id, text)`` with ``base`` (the base spans)
    and ``spans`` (all), arrays of (kind from 1, start, end) in this order, in
    code points, the end exclusive.

    ``max_train`` bounds the labelled candidates that the trees learn from (a
    hash sample of about that many, all where there are fewer)."""
    measured = stored(measure(documents), "pii-measured")
    raw = measured.select("row", F.explode("raw").alias("x")).select("row", "x.*")
    found = stored(labelled(candidates(measured), raw), "pii-candidates")
    added = without_overlaps(judged(found, max_train, trees, depth, recall, least))
    added = stored(added.groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("added")), "pii-added")
    base = F.array_sort(F.transform(F.filter("raw", lambda x: x["valid"]), lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))))
    spans = F.array_sort(F.concat("base", F.coalesce("added", F.array().cast("array<struct<kind:int,start:int,end:int>>"))))
    return measured.select("row", "doc_id", base.alias("base")).join(broadcast_if_small(added), "row", "left").select("doc_id", "base", spans.alias("spans"))


def count_of(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == KINDS.index(kind) + 1)).cast("bigint")


def digest(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    name = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(name, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")
