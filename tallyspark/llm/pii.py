"""Personal data by candidate gradient boosting, in DataFrame operations only.

High-recall generators propose overlapping spans: every match of the base
patterns, valid or not, and looser forms (numbers with other separators,
addresses with a spelt-out at sign).  Every candidate gets format features
and context features.  Boosted trees are grown on the driver from one bounded
table: the distinct feature combinations of all candidates with their counts.
The trees become one SQL expression; one threshold per generator, calibrated
on documents held out of the growing, selects the looser spans to add.  Base
spans always stay, and matches that fail their base rule are never added.

The label of a candidate is evidence that no feature holds.  A match of a base
pattern is positive where it meets a valid base span.  A looser number is
positive where it meets one, where its 12 to 19 digits pass the Luhn check, or
where its last nine digits are those of a valid span of the same document.  A
looser address is positive where it meets a valid one or names the domain of a
valid address anywhere in the table.  All other candidates are negatives, true
ones without evidence among them, so the calibrated precision is a lower bound.

Texts are read once: the matches with their surroundings are stored, and
everything after works on them.  Positions come from running sums over the
gaps between matches, so long texts take linear time.  The patterns are
written with possessive loops and anchored starts so that runs of digits or
letters of any length neither overflow the matcher's stack nor take squared
time; they match the same strings as the plain forms.

Defined results: null and empty texts have no spans; repeated rows, also of
one doc_id or of none, are separate rows; spans of one start go by kind, then
end; a table without candidates adds nothing, an empty one gives no row.
Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyspark.llm.shared import stored

# The base kinds in order, and their patterns.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Looser forms; what they add is reported under the kind named.
LOOSE = {
    "loose_number": (r"(?<![0-9A-Za-z])[(]?[0-9](?:[\x20()./-]{0,2}[0-9]){8,18}+(?![0-9A-Za-z])", "phone"),
    "loose_email": (rf"(?<!{_LOCAL}){_LOCAL}{{1,64}}+\s?[\[(]at[\])]\s?[A-Za-z0-9-]++"
                    r"(?:(?:\.|\s?[\[(]dot[\])]\s?)[A-Za-z0-9-]++)++", "email"),
}
_OCTETS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.|$)){4}"
_CUES = r"(?i)\b(?:call|tel|phone|mobile|fax|contact|mail|e-mail|card|visa|address|ip)\b"
CONTEXT = 24

FEATURES = ("which", "digits", "chars", "groups", "plus", "parens", "dots", "dashes", "slashes", "tail", "cue", "named",
            "glued")
#: Size of the model; the combination table is bounded by the feature ranges.
ROUNDS, DEPTH, RATE, PRECISION, FOLDS = 24, 3, 0.4, 0.98, 5
#: Digits by which a number is known again.
KNOWN_DIGITS = 9


# ------------------------------------------------------------------ candidates
def _matches(text: Column, pattern: str, worth: Column) -> Column:
    return F.when(worth, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))


def _surroundings(text: Column, pattern: str, matches: Column) -> Column:
    """The gaps around the matches: their lengths and their edges."""
    gap = lambda g: F.struct(F.length(g).alias("n"), F.right(g, F.lit(CONTEXT)).alias("left"),
                             F.left(g, F.lit(1)).alias("right"))
    return F.when(F.size(matches) > 0, F.transform(F.split(text, pattern, -1), gap))


def matches_table(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(rid, doc_id, per generator its matches and gaps), stored; the only
    pass over the texts."""
    text = F.col("t")
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    number = text.rlike("[0-9]")
    worth = {"email": text.contains("@"), "ip": number, "card": number, "phone": text.contains("+"),
             "loose_number": number, "loose_email": text.contains("at)") | text.contains("at]")}
    patterns = PATTERNS | {k: p for k, (p, _) in LOOSE.items()}
    found = rows.select("rid", "doc_id", "t", *[_matches(text, p, worth[k]).alias(k) for k, p in patterns.items()])
    around = found.select("rid", "doc_id", *patterns,
                          *[_surroundings(text, p, F.col(k)).alias(f"{k}_gaps") for k, p in patterns.items()])
    return stored(spark, around, "pii-matches")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    def weighed(i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        doubled = F.when(i % 2 == 0, d * 2).otherwise(d)
        return F.when(doubled > 9, doubled - 9).otherwise(doubled)
    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda s, i: s + weighed(i))
    return total % 10 == 0


def candidates(found: DataFrame) -> DataFrame:
    """One row per proposed span: rid, doc_id, generator, start, end (code
    points), base (a valid base span), met (overlaps a valid base span),
    backed (evidence within the document), domain (of an address) and the
    features."""
    spans = None
    for g in (*KINDS, *LOOSE):
        part = found.select("rid", "doc_id", F.posexplode(g).alias("i", "match"), f"{g}_gaps").select(
            "rid", "doc_id", F.lit(g).alias("generator"), "i", "match",
            F.get(f"{g}_gaps", F.col("i"))["n"].alias("gap"), F.get(f"{g}_gaps", F.col("i"))["left"].alias("left"),
            F.get(f"{g}_gaps", F.col("i") + 1)["right"].alias("right"))
        spans = part if spans is None else spans.unionByName(part)
    along = Window.partitionBy("rid", "generator").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    size = F.length("match")
    spans = (spans.withColumn("end", F.sum(F.col("gap") + size).over(along)).withColumn("start", F.col("end") - size)
             .withColumn("d", F.regexp_replace("match", "[^0-9]", "")))
    digits = F.length("d")
    checked = digits.between(12, 19) & luhn(F.when(digits.between(12, 19), F.col("d")))
    spans = spans.withColumn("luhn", F.coalesce(checked, F.lit(False)))
    valid = (F.when(F.col("generator") == "email", F.lit(True))
             .when(F.col("generator") == "ip", F.col("match").rlike(_OCTETS))
             .when(F.col("generator") == "card", F.col("luhn"))
             .when(F.col("generator") == "phone", digits.between(9, 15)).otherwise(F.lit(False)))
    count = lambda chars: F.least(F.length(F.regexp_replace("match", f"[^{chars}]", "")), F.lit(4))
    dotted = F.regexp_replace("match", r"\s?[\[(]dot[\])]\s?", ".")
    domain = F.when(F.col("generator").contains("email"), F.lower(F.regexp_extract(dotted, r"(?:@|at[\])])\s?([A-Za-z0-9.-]+)$", 1)))
    spans = spans.select(
        "rid", "doc_id", "generator", "start", "end", valid.alias("base"), "luhn", domain.alias("domain"),
        F.when(digits >= KNOWN_DIGITS, F.right("d", F.lit(KNOWN_DIGITS))).alias("known"),
        (F.array_position(F.array(*map(F.lit, (*KINDS, *LOOSE))), F.col("generator")) - 1).cast("int").alias("which"),
        F.least(digits, F.lit(20)).alias("digits"), F.least(F.floor(size / 4).cast("int"), F.lit(8)).alias("chars"),
        F.least(F.size(F.split("match", "[^0-9]+")), F.lit(6)).alias("groups"),
        (F.col("match").contains("+") | F.col("left").endswith("+")).cast("int").alias("plus"),
        F.col("match").contains("(").cast("int").alias("parens"),
        count(".").alias("dots"), count("-").alias("dashes"), count("/").alias("slashes"),
        F.col("match").rlike(r"[.)\]]\s?[A-Za-z]{2,}$").cast("int").alias("tail"),
        F.col("left").rlike(_CUES).cast("int").alias("cue"),
        F.col("left").rlike(r"[:=#]\s?$").cast("int").alias("named"),
        (F.col("left").rlike("[0-9A-Za-z]$") | F.coalesce(F.col("right").rlike("^[0-9A-Za-z]"), F.lit(False)))
        .cast("int").alias("glued"))
    upto = Window.partitionBy("rid").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("rid").orderBy("start", "end").rowsBetween(1, Window.unboundedFollowing)
    met = (F.col("base") | F.coalesce(F.max(F.when(F.col("base"), F.col("end"))).over(upto) > F.col("start"), F.lit(False))
           | F.coalesce(F.min(F.when(F.col("base"), F.col("start"))).over(after) < F.col("end"), F.lit(False)))
    again = F.max("base").over(Window.partitionBy("rid", "known"))
    backed = F.col("met") | ((F.col("generator") == "loose_number") & (F.col("luhn") | (F.col("known").isNotNull() & again)))
    return spans.withColumn("met", met).withColumn("backed", backed).drop("luhn", "known")


# ------------------------------------------------------------------ boosted trees
def _tree(rows, grads, hess, at, depth):
    """A nested (feature, bound, low side, high side), or a leaf's value."""
    g, h = sum(grads[i] for i in at), sum(hess[i] for i in at)
    best = (1e-6, None)
    if depth:
        for f in range(len(FEATURES)):
            sums: dict[int, list[float]] = {}
            for i in at:
                s = sums.setdefault(rows[i][f], [0.0, 0.0])
                s[0] += grads[i]
                s[1] += hess[i]
            lg = lh = 0.0
            for bound in sorted(sums)[:-1]:
                lg, lh = lg + sums[bound][0], lh + sums[bound][1]
                gain = lg * lg / (lh + 1) + (g - lg) ** 2 / (h - lh + 1) - g * g / (h + 1)
                best = max(best, (gain, (f, bound)), key=lambda x: x[0])
    if best[1] is None:
        return -RATE * g / (h + 1.0)
    f, bound = best[1]
    low, high = [i for i in at if rows[i][f] <= bound], [i for i in at if rows[i][f] > bound]
    return f, bound, _tree(rows, grads, hess, low, depth - 1), _tree(rows, grads, hess, high, depth - 1)


def _value(tree, row) -> float:
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def boosted(rows: list[tuple], positive: list[float], total: list[float]) -> list:
    """Trees grown by logistic gradient boosting over weighted feature rows."""
    margins, trees = [0.0] * len(rows), []
    for _ in range(ROUNDS if rows else 0):
        p = [1 / (1 + math.exp(-m)) for m in margins]
        grads = [n * q - s for n, q, s in zip(total, p, positive, strict=True)]
        hess = [n * q * (1 - q) for n, q in zip(total, p, strict=True)]
        trees.append(_tree(rows, grads, hess, range(len(rows)), DEPTH))
        margins = [m + _value(trees[-1], r) for m, r in zip(margins, rows, strict=True)]
    return trees


def _sql(tree) -> str:
    if not isinstance(tree, tuple):
        return f"{tree!r}D"
    return f"CASE WHEN {FEATURES[tree[0]]} <= {tree[1]} THEN {_sql(tree[2])} ELSE {_sql(tree[3])} END"


def threshold(scored: list[tuple[float, float, float]]) -> float:
    """The lowest margin from which on the held-out share of positives is at
    least ``PRECISION``; scored: (margin, positives, all).  Candidates of one
    margin are taken or left together."""
    ordered = sorted(scored, reverse=True)
    best, s, n = math.inf, 0.0, 0.0
    for i, (margin, positive, total) in enumerate(ordered):
        s, n = s + positive, n + total
        tied = i + 1 < len(ordered) and margin - ordered[i + 1][0] <= 1e-9
        if not tied and s >= PRECISION * n:
            best = margin
    return best


def labelled(spans: DataFrame) -> DataFrame:
    """(held, features, s, n): positives and all per feature combination.

    Addresses are counted per domain before they meet the valid domains, so a
    domain that very many of them name is one row there."""
    fold = (F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)) == 0).alias("held")
    counts = [F.sum(F.col("backed").cast("long")).alias("s"), F.count(F.lit(1)).alias("n")]
    spelt = F.col("generator") == "loose_email"
    others = spans.where(~spelt).groupBy(fold, *FEATURES).agg(*counts)
    valid = spans.where((F.col("generator") == "email") & F.col("base")).select("domain").distinct()
    named = spans.where(spelt).groupBy(fold, *FEATURES, "domain").agg(*counts).join(
        valid.withColumn("valid", F.lit(True)), "domain", "left")
    named = named.select("held", *FEATURES, F.when(F.col("valid"), F.col("n")).otherwise(F.col("s")).alias("s"), "n")
    return others.unionByName(named).groupBy("held", *FEATURES).agg(F.sum("s").alias("s"), F.sum("n").alias("n"))


def model(spans: DataFrame) -> tuple[Column, dict[str, float], dict[str, tuple[float, float, int]]]:
    """The margin of a candidate as a column; per generator the calibrated
    threshold, and its held-out precision, recall (both by the labels) and
    number of candidates."""
    table = labelled(spans).collect()
    grown = [r for r in table if not r.held]
    trees = boosted([tuple(r[f] for f in FEATURES) for r in grown], [float(r.s) for r in grown], [float(r.n) for r in grown])
    least, report = {}, {}
    for which, generator in enumerate((*KINDS, *LOOSE)):
        held = [(sum(_value(t, [r[f] for f in FEATURES]) for t in trees), r.s, r.n)
                for r in table if r.held and r.which == which]
        least[generator] = threshold(held)
        s, n = (sum(r[k] for r in held if r[0] >= least[generator]) for k in (1, 2))
        positive = sum(r[1] for r in held)
        report[generator] = (s / n if n else math.nan, s / positive if positive else math.nan, sum(r[2] for r in held))
    margin = F.expr(" + ".join(_sql(t) for t in trees)) if trees else F.lit(0.0)
    return margin, least, report


# ------------------------------------------------------------------ spans
def _joined(spans: Column) -> Column:
    ordered = F.sort_array(F.filter(spans, lambda s: s.isNotNull()))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def personal_data(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, base counts per kind, base_sha256 and all spans, per row."""
    found = matches_table(spark, docs)
    spans = stored(spark, candidates(found), "pii-candidates")
    margin, least, _ = model(spans)
    bound = F.lit(math.inf)
    for name in LOOSE:
        bound = F.when(F.col("generator") == name, F.lit(least[name] - 1e-9)).otherwise(bound)
    loose = F.col("generator").isin(*LOOSE) & ~F.col("met") & (margin >= bound)
    kept = spans.withColumn("added", loose).where("base OR added")
    kind = F.col("generator")
    for name, (_, reported) in LOOSE.items():
        kind = F.when(F.col("generator") == name, reported).otherwise(kind)
    place = F.array_position(F.array(*map(F.lit, KINDS)), kind)
    span = F.struct("start", place.alias("place"), kind.alias("kind"), "end")
    of_base = F.collect_list(F.when(F.col("base"), span))
    counts = [F.count(F.when(F.col("base") & (F.col("generator") == k), 1)).alias(f"n_{k}") for k in KINDS]
    per_row = kept.groupBy("rid").agg(*counts, of_base.alias("b"), F.collect_set(span).alias("a")).select(
        "rid", *[f"n_{k}" for k in KINDS], _joined(F.col("b")).alias("base_spans"), _joined(F.col("a")).alias("spans"))
    joined = found.select("rid", "doc_id").join(per_row, "rid", "left")
    empty = F.lit("")
    return joined.select("doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS],
                         F.sha2(F.coalesce("base_spans", empty), 256).alias("base_sha256"),
                         F.coalesce("spans", empty).alias("spans"))
