"""Secrets by multipart credential linking, in DataFrame operations only.

A credential has parts: an access identifier, a secret and an endpoint.
Generators propose spans for each part:

* the base patterns (``KINDS``): matches that pass their length check are
  always reported;
* weak forms: base matches that fail the check, identifiers and secrets named
  by other key words, long mixed tokens.  On their own they are noise;
* endpoints, which are evidence and never reported.

Weak candidates are joined with the other parts by interval: same row, same
scope (the text between two blank lines), apart by at most ``WINDOW`` code
points and not overlapping.  A weak identifier is reported if a secret is
linked to it, a weak secret if an identifier or an endpoint is.  Both sides of
the join are dealt by row, scope and ``WINDOW``-sized cell; a cell holds at
most ``WINDOW`` / 4 parts of each role, as spans of one generator never
overlap, so the number of pairs is proportional to the length of the text.

Texts are read once: the lengths of matches and of the gaps between them are
stored, and positions come from running sums over them, in linear time.  The
patterns are written with possessive loops, so runs of any length neither
overflow the matcher's stack nor are searched again; they match the same
strings as the plain forms.  Key words match ASCII letters in either case.

Defined results: null and empty texts have no spans; repeated rows, also of
one doc_id or of none, are separate rows; spans that several generators of one
kind propose are reported once; an empty table gives no row.  Columns other
than doc_id and text are not looked at.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyspark.llm.shared import stored

# The base kinds in order, their key words, characters and least lengths.
KINDS = ("assign", "access", "hex")
_VALUE = "[A-Za-z0-9+/_.=-]"
_LEAST = {"assign": 12, "access": 18, "hex": 16}


def _keyed(words: str, value: str) -> str:
    """A key word, a colon or equals sign, and a value in group 1."""
    return rf"""(?i:{words})["']?+\x20*+[:=]\x20*+["']?+({value})"""


PATTERNS = {
    "assign": _keyed("password|passwd|secret|token|api_?key", f"{_VALUE}++"),
    "access": "AKIA[A-Z0-9]++",
    "hex": "(?<![0-9a-f])[0-9a-f]{16,}+",
    "identifier": _keyed("access_?key_?id|client_?id|app_?id|account|user_?name|user|login", "[A-Za-z0-9+/_.@-]{3,}+"),
    "keyed": _keyed("pass_?phrase|pass|pwd|auth|credentials?|private_?key|access_?key|signature|bearer",
                    r"[A-Za-z0-9+/_.=~!@#$%^&*-]{6,}+"),
    "mixed": r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}",
    "url": r"(?<![A-Za-z0-9+-])[A-Za-z][A-Za-z0-9+-]{1,15}+://[A-Za-z0-9._-]++(?::[0-9]{1,5}+)?+",
    "host": _keyed("host_?name|host|endpoint|server|base_?url|url", "[A-Za-z0-9._:/-]{4,}+"),
}
#: The kind and the role of what a generator proposes.
KIND = {"assign": "assign", "access": "access", "hex": "hex", "identifier": "access", "keyed": "assign", "mixed": "hex"}
ROLE = {"assign": "secret", "access": "identifier", "hex": "secret", "identifier": "identifier", "keyed": "secret",
        "mixed": "secret", "url": "endpoint", "host": "endpoint"}
#: Roles that make a weak candidate of this role worth reporting.
COMPLEMENT = {"identifier": ("secret",), "secret": ("identifier", "endpoint")}
#: Least characters of a failed base match that counts as a weak candidate:
#: of the value, or of the identifier.
WEAK_LEAST = {"assign": 6, "access": 12}
_BLANK = r"\n[\x20\t\r]*+\n"
#: Code points that linked parts may lie apart.
WINDOW = 400


def matches_table(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(rid, doc_id, per generator and for blank lines the matches' traits
    and the lengths of the gaps before them), stored; the only pass over the
    texts."""
    text = F.col("t")
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    sign = text.contains(":") | text.contains("=")
    worth = {"access": text.contains("AKIA"), "url": text.contains("://")} | dict.fromkeys(("assign", "identifier", "keyed", "host"), sign)
    found = rows.select("*", *[F.when(worth.get(g, F.lit(True)), F.regexp_extract_all(text, F.lit(p), F.lit(0))).alias(g)
                               for g, p in PATTERNS.items()])
    # only rows with something to link need their scopes
    weak = F.lit(False)
    for g in ("assign", "access", "identifier", "keyed", "mixed"):
        weak = weak | (F.size(g) > 0)
    found = found.withColumn("blank", F.when(weak, F.regexp_extract_all(text, F.lit(_BLANK), F.lit(0))))
    gaps = lambda g, p: F.when(F.size(g) > 0, F.transform(F.split(text, p, -1), lambda x: F.length(x)))
    return stored(spark, found.select(
        "rid", "doc_id", *[F.transform(g, partial(_traits, g)).alias(g) for g in (*PATTERNS, "blank")],
        *[gaps(g, p).alias(f"{g}_gaps") for g, p in (*PATTERNS.items(), ("blank", _BLANK))]), "secret-matches")


def _traits(generator: str, match: Column) -> Column:
    """Length, whether a valid base span, whether a weak candidate."""
    size, no, yes = F.length(match), F.lit(False), F.lit(True)
    if generator in _LEAST:
        held = F.length(F.regexp_extract(match, PATTERNS["assign"], 1)) if generator == "assign" else size
        base, weak = held >= _LEAST[generator], held >= WEAK_LEAST.get(generator, _LEAST[generator])
    elif generator == "mixed":
        base, weak = no, match.rlike("[0-9]") & match.rlike("[A-Z]")
    else:
        base, weak = no, yes if generator in KIND else no
    return F.struct(size.alias("size"), base.alias("base"), (weak & ~base).alias("weak"))


def parts(found: DataFrame) -> DataFrame:
    """One row per part: rid, scope, generator, role, start, end (code points,
    end exclusive), base, weak.  Weak forms that overlap a base span are left
    out; they are reported already."""
    spans = None
    for g in (*PATTERNS, "blank"):
        part = found.select("rid", F.posexplode(g).alias("i", "m"), f"{g}_gaps").select(
            "rid", F.lit(g).alias("generator"), "i", "m.*", F.get(f"{g}_gaps", F.col("i")).alias("gap"))
        spans = part if spans is None else spans.unionByName(part)
    along = Window.partitionBy("rid", "generator").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    spans = spans.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(along)).withColumn("start", F.col("end") - F.col("size"))
    spans = spans.where("base OR weak OR generator IN ('url', 'host', 'blank')")
    by_place = Window.partitionBy("rid").orderBy("start", "end")
    before, after = by_place.rowsBetween(Window.unboundedPreceding, -1), by_place.rowsBetween(1, Window.unboundedFollowing)
    spans = spans.select(
        "*", F.coalesce(F.sum((F.col("generator") == "blank").cast("int")).over(before), F.lit(0)).alias("scope"),
        F.max(F.when(F.col("base"), F.col("end"))).over(before).alias("base_until"),
        F.min(F.when(F.col("base"), F.col("start"))).over(after).alias("base_from"))
    covered = F.coalesce(F.col("base_until") > F.col("start"), F.lit(False)) | F.coalesce(F.col("base_from") < F.col("end"), F.lit(False))
    role = F.create_map(*[F.lit(x) for g, r in ROLE.items() for x in (g, r)])[F.col("generator")]
    return spans.where((F.col("generator") != "blank") & ~(F.col("weak") & covered)).select(
        "rid", "scope", "generator", role.alias("role"), "start", "end", "base", "weak")


def links(spans: DataFrame, window: int = WINDOW) -> DataFrame:
    """(rid, generator, start, end, partner_role, partner_start, partner_end):
    every weak candidate with every complementary part in its scope within
    ``window`` code points of it."""
    cell = lambda x: F.floor(F.col(x) / window).cast("long")
    weak = spans.where("weak").select(
        "rid", "scope", "generator", "role", "start", "end",
        F.explode(F.sequence(cell("start") - 1, cell("end") + 1)).alias("cell"))
    partner = spans.select("rid", "scope", F.col("role").alias("partner_role"), F.col("start").alias("partner_start"),
                           F.col("end").alias("partner_end"), F.explode(F.array_distinct(F.array(cell("start"), cell("end")))).alias("cell"))
    fits = F.lit(False)
    for role, others in COMPLEMENT.items():
        fits = fits | ((F.col("role") == role) & F.col("partner_role").isin(*others))
    gap = F.greatest(F.col("partner_start") - F.col("end"), F.col("start") - F.col("partner_end"))
    joined = weak.join(partner, ["rid", "scope", "cell"]).where(fits & gap.between(0, window))
    return joined.drop("scope", "cell", "role").distinct()


def findings(spark: SparkSession, found: DataFrame, window: int = WINDOW) -> DataFrame:
    """(rid, kind, start, end, base, partners) of every reported span; weak
    ones carry the parts that they are reported for.  Stored."""
    spans = stored(spark, parts(found), "secret-parts")
    kind = F.create_map(*[F.lit(x) for g, k in KIND.items() for x in (g, k)])[F.col("generator")]
    added = links(spans, window).groupBy("rid", kind.alias("kind"), "start", "end").agg(
        F.lit(False).alias("base"), F.array_sort(F.collect_set(F.struct(
            F.col("partner_start").alias("start"), F.col("partner_end").alias("end"), F.col("partner_role").alias("role")))).alias("partners"))
    base = spans.where("base").select("rid", kind.alias("kind"), "start", "end", "base",
                                      F.lit(None).cast(added.schema["partners"].dataType).alias("partners"))
    return stored(spark, base.unionByName(added), "secret-findings")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secrets(spark: SparkSession, docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, base counts per kind, base_sha256 and all spans, per row."""
    found = matches_table(spark, docs)
    place = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    span = F.struct("start", place.alias("place"), "end", "kind")
    per_row = findings(spark, found, window).groupBy("rid").agg(
        *[F.count_if(F.col("base") & (F.col("kind") == k)).alias(f"n_{k}") for k in KINDS],
        F.collect_list(F.when(F.col("base"), span)).alias("base_spans"), F.collect_list(span).alias("spans"))
    per_row = per_row.select("rid", *[f"n_{k}" for k in KINDS], _joined(F.col("base_spans")).alias("base_spans"), _joined(F.col("spans")).alias("spans"))
    joined = found.select("rid", "doc_id").join(per_row, "rid", "left")
    return joined.select("doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).alias(f"n_{k}") for k in KINDS],
                         F.sha2(F.coalesce("base_spans", F.lit("")), 256).alias("base_sha256"),
                         F.coalesce("spans", F.lit("")).alias("spans"))
