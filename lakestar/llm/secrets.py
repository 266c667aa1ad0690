"""Secret scan: spans of access identifiers, secrets and endpoints, and links between their parts.

Strong spans (an assignment to a secret's name, an access identifier, a long hex run) are
reported wherever they stand. Weak candidates (an endpoint, a user name, an opaque string) are
everywhere in harmless text; they are reported only if a part that complements them overlaps
their scope, some characters to either side: credentials come in parts. An opaque string must look
like a drawn one: letters, digits and cases change often in it, and it has many different
characters; the words, numbers and dates of slugs, paths and names stand apart. With ``apart``, candidates
cut from one text are not parts of each other: of those that overlap the kind listed first counts.

The link is an interval join. Text is cut into cells as wide as the scope reaches; of the parts
that overlap a cell only the first start and the last end are kept per role, which is enough to
tell whether one overlaps an interval, so no pairs of parts are made. All of it is DataFrame
expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestar.llm.common import col, numbered, step_aside, written

#: Code points to either side of a weak candidate in which a complementary part is looked for.
REACH = 200
SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"


@dataclass(frozen=True)
class Kind:
    """``least``: code points of the match, or of ``group``, below which it is dropped."""

    name: str
    regex: str
    role: str
    strong: bool
    least: int = 0
    group: int = 0
    #: a text without a match of this has no span of the kind; cheap
    hint: str = ""


_ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
    r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
#: Where a drawn string changes: letter to digit, digit to letter; and lower case to upper.
NUMBERED = "(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])"
CHANGES = NUMBERED + "|(?<=[a-z])(?=[A-Z])"
#: A drawn string has a change in so many characters at least, two of them at digits, and so many different characters.
STRETCH, DIGIT_CHANGES, DISTINCT = 5, 2, 10
#: In the order in which spans with the same start are listed; strong kinds first.
KINDS = (
    Kind("assign", _ASSIGN, "secret", True, 8, 2, r"[:=]"),
    Kind("access", r"AKIA[A-Z0-9]+", "id", True, 16, 0, "AKIA"),
    Kind("hex", r"[0-9a-f]{32,}", "secret", True, 32),
    Kind("endpoint", r"[a-z]{2,10}://[^\x00-\x20\"'<>]+", "place", False, 8, 0, "://"),
    Kind("user", r"(?:[Uu]ser(?:name)?|[Ll]ogin|[Aa]ccount|[Cc]lient_?[Ii]d)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9@._-]+)", "id", False, 3, 1, r"[:=]"),
    Kind("opaque", r"[A-Za-z0-9+/_=-]{20,}", "secret", False, 20, 0, r"[0-9]"),
)
#: Roles that complement a weak candidate's own.
COMPLEMENT = {"id": ("secret",), "secret": ("id", "place"), "place": ("secret",)}


def drawn(x: Column) -> Column:
    """Whether a string looks drawn at random rather than written."""
    return (
        (F.regexp_count(x, F.lit(CHANGES)) * STRETCH >= F.length(x))
        & (F.regexp_count(x, F.lit(NUMBERED)) >= DIGIT_CHANGES)
        & (F.size(F.array_distinct(F.split(x, ""))) >= DISTINCT)
    )


def _pieces(text: Column, kind: Kind) -> Column:
    """Per match: code points before it since the last one, of itself, of what ``least`` is about."""
    found = F.regexp_extract_all(text, F.lit(kind.regex), F.lit(0))
    judged = F.regexp_extract_all(text, F.lit(kind.regex), F.lit(kind.group)) if kind.group else found
    random = F.transform(found, drawn if kind.name == "opaque" else lambda _: F.lit(True))
    gaps = F.split(text, kind.regex, -1)
    lengths = F.zip_with(
        F.zip_with(gaps, found, lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("size"))),
        F.zip_with(judged, random, lambda j, d: F.struct(F.length(j).alias("judged"), d.alias("drawn"))),
        lambda a, b: F.struct(a["gap"].alias("gap"), a["size"].alias("size"), b["judged"].alias("judged"), b["drawn"].alias("drawn")),
    )
    matches = F.filter(lengths, lambda x: x["size"].isNotNull())
    return F.when(text.rlike(kind.hint), matches) if kind.hint else matches


def spans(rows: DataFrame, text: str, reach: int = REACH, apart: bool = False) -> DataFrame:
    """``row_no``, ``kind``, ``start``, ``end`` (code points, end exclusive) of what is reported.

    ``rows`` are numbered. Matches of one kind are leftmost and don't overlap; opaque strings
    must look drawn, and a weak candidate is dropped where a strong span covers part of it.
    With ``apart`` it is dropped, too, where a weak candidate of a kind listed before does: the piece of a
    link that looks opaque, or a long user name, is no secret beside the link or the name.
    """
    whole = F.coalesce(col(text), F.lit(""))
    none = F.array().cast("array<struct<gap:int,size:int,judged:int,drawn:boolean>>")
    pieces = rows.select(
        "row_no",
        F.explode(F.array(*[F.struct(F.lit(i).alias("kind_no"), F.coalesce(_pieces(whole, k), none).alias("m")) for i, k in enumerate(KINDS)])).alias("k"),
    ).select("row_no", "k.kind_no", F.posexplode("k.m").alias("pos", "m"))
    order = Window.partitionBy("row_no", "kind_no").orderBy("pos")
    end = F.sum(F.col("gap") + F.col("size")).over(order)
    least = F.element_at(F.array(*[F.lit(k.least) for k in KINDS]), F.col("kind_no") + 1)
    named = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("kind_no") + 1)
    found = written(
        pieces.select("row_no", "kind_no", "pos", "m.*")
        .withColumn("end", end)
        .where((F.col("judged") >= least) & F.col("drawn"))
        .select(
            "row_no",
            "kind_no",
            named([k.name for k in KINDS]).alias("kind"),
            named([k.role for k in KINDS]).alias("role"),
            named([k.strong for k in KINDS]).alias("strong"),
            (F.col("end") - F.col("size")).alias("start"),
            "end",
        ),
        "secret-spans",
    )
    strong, weak = found.where("strong"), found.where("not strong")
    reached = written(_linked(weak, strong, reach, apart), "secret-links")
    return strong.select("row_no", "kind_no", "kind", "start", "end").unionByName(reached)


def _cells(parts: DataFrame, width: int, lo: Column, hi: Column) -> DataFrame:
    cell = F.sequence(F.floor(lo / width), F.floor((hi - 1) / width))
    return parts.withColumn("cell", F.explode(cell))


def _bounds(parts: DataFrame, width: int) -> DataFrame:
    """Per cell and role the first start and the last end of the parts that overlap the cell."""
    return (
        _cells(parts, width, F.col("start"), F.col("end"))
        .groupBy("row_no", "cell", "role")
        .agg(F.min("start").alias("first"), F.max("end").alias("last"))
        .withColumnsRenamed({"role": "other", "cell": "at", "row_no": "of"})
    )


def _overlapping(parts: DataFrame, bounds: DataFrame, width: int, lo: Column, hi: Column, fits: Column) -> DataFrame:
    """``row_no``, ``kind_no``, ``start`` of the parts whose (lo, hi) a fitting part overlaps."""
    spread = _cells(parts.withColumns({"lo": lo, "hi": hi}), width, F.greatest("lo", F.lit(0)), F.col("hi"))
    met = (F.col("row_no") == F.col("of")) & (F.col("cell") == F.col("at")) & fits
    return (
        spread.join(bounds, met & (F.col("first") < F.col("hi")) & (F.col("last") > F.col("lo")))
        .select("row_no", "kind_no", "start")
        .distinct()
    )


def _uncovered(weak: DataFrame, covers: DataFrame) -> DataFrame:
    """The weak candidates that no cover of their row overlaps whose kind is listed before theirs."""
    order = Window.partitionBy("row_no").orderBy("key", "cover").rowsBetween(Window.unboundedPreceding, 0)
    met = F.lit(None)
    for i in [i for i, k in enumerate(KINDS) if not k.strong]:
        before = F.max(F.when(F.col("cover") & (F.col("kind_no") < i), F.col("end"))).over(order)
        met = F.when(F.col("kind_no") == i, before).otherwise(met)
    event = lambda parts, key, cover: parts.withColumns({"key": F.col(key), "cover": F.lit(cover)})
    return (
        event(weak, "end", False).unionByName(event(covers, "start", True))
        .withColumn("met", F.coalesce(met, F.lit(-1)))
        .where(~F.col("cover") & (F.col("met") <= F.col("start")))
        .drop("key", "cover", "met")
    )


def _linked(weak: DataFrame, strong: DataFrame, reach: int, apart: bool) -> DataFrame:
    """The weak candidates that no strong span overlaps and that a complementary part is near."""
    keys = ["row_no", "kind_no", "start"]
    start, end = F.col("start"), F.col("end")
    alone = written(_uncovered(weak, strong.unionByName(weak) if apart else strong), "secret-weak")
    fits = F.lit(False)
    for role, others in COMPLEMENT.items():
        fits = fits | ((F.col("role") == role) & F.col("other").isin(*others))
    parts = alone.unionByName(strong)
    near = _overlapping(alone, _bounds(parts, reach), reach, start - reach, end + reach, fits)
    return alone.join(near, keys, "left_semi").select("row_no", "kind_no", "kind", "start", "end")


def scan(df: DataFrame, text: str = "text", reach: int = REACH, apart: bool = False) -> DataFrame:
    """All rows and columns with ``found``: the spans as structs of kind, start, end, in order.

    ``apart`` as in ``spans``. By start, then kind as listed in ``KINDS``; empty for a null or empty text. Rows are numbered,
    so null and repeated ids don't matter; an empty table gives an empty one. An input column
    called found is kept as ``found_input``.
    """
    rows = numbered(step_aside(df, ("found", "row_no")), "secret-rows")
    each = F.struct("start", "kind_no", "kind", "end")
    lists = (
        spans(rows, text, reach, apart)
        .groupBy("row_no")
        .agg(F.sort_array(F.collect_list(each)).alias("listed"))
        .select("row_no", F.transform("listed", lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))).alias("found"))
    )
    return (
        rows.join(lists, "row_no", "left")
        .withColumn("found", F.coalesce(F.col("found").cast(SPANS), F.array().cast(SPANS)))
        .drop("row_no")
    )


def listed(found: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
