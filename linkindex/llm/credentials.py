"""Secret scans with multipart credential linking, by Spark expressions only.

Three kinds of spans stand on their own: ``assign``, ``access`` and ``hex``. Other parts are weak:
names of an account (``ident``), high-entropy strings (``secret``) and addresses of a service
(``endpoint``) are common in harmless text. They are linked: a weak part is reported only if within
its scope, ``SCOPE`` code points on either side, complementary parts co-occur:

* ``ident``: a secret, that is an ``assign``, ``hex`` or ``secret`` span;
* ``secret``: an access identifier, that is an ``access`` or ``ident`` span;
* ``endpoint``: an access identifier and a secret.

All positions are code points, with exclusive ends. The parts of a row are arrays of that row, and the
interval join runs there, as one sweep over the starts of one side and the reach of the other, in order. So nothing
is shuffled, no text leaves its row, and twice as many parts take about twice the time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkindex.llm.arrays import let, pieces, running, running_sums
from linkindex.llm.common import fresh, quoted

#: Code points on either side of a part in which its complements are looked for.
SCOPE = 200
MASK = "[SECRET]"

# The patterns of the kinds, in their order.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]++"
HEX = r"[0-9a-f]{24,}+"  # runs are maximal, so shorter ones need not be found first
IDENT = (r"(?i)\b(?:user(?:name|_?id)?|login|account(?:_?id)?|client_?id|access_?key(?:_?id)?)"
         r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9@+/_.=-]{3,}+)""")
SECRET = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{32,}+={0,2}(?![A-Za-z0-9+/_=-])"
ENDPOINT = (r"(?i)\b(?:https?|ftp|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\s\"'<>]++"
            r"|\b(?:host|endpoint|server)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9.:-]{4,}+")

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "ident", "secret", "endpoint")

_SPAN = "array<struct<start:bigint,order:int,end:bigint>>"


def _spans(text: Column, pattern: str, kind: str, keep=None) -> Column:
    """Spans of the leftmost matches that do not overlap, in order; ``keep`` tests a match's text."""
    order = KINDS.index(kind)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)  # what lies between the matches, so their places add up

    def located(matches: Column, gaps: Column) -> Column:
        ends = running_sums(F.transform(matches, lambda m, k: F.length(m) + F.length(F.get(gaps, k))))
        spans = let(ends, lambda ends: F.transform(matches, lambda m, k: F.struct(
            (F.get(ends, k) - F.length(m)).alias("start"), F.lit(order).alias("order"),
            F.get(ends, k).alias("end"), m.alias("match"))))
        if keep is not None:
            spans = F.filter(spans, lambda s: keep(s["match"]))
        return F.transform(spans, lambda s: F.struct(s["start"], s["order"], s["end"]))

    found = let(matches, lambda m: let(gaps, lambda g: located(m, g)))
    # most texts have no match, and then one pass over the text is all
    return F.when(text.rlike(pattern), found.cast(_SPAN)).otherwise(F.array().cast(_SPAN))


def _near(parts: Column, others: Column) -> Column:
    """The ``parts`` whose scope an interval of ``others`` meets.

    In the order of the others' starts and of the places up to which parts reach, an other that begins within a
    part's reach comes before it; it meets the scope if the furthest end so far does.
    """
    events = F.array_sort(F.concat(
        F.transform(others, lambda o: F.struct(
            o["start"].alias("at"), F.lit(0).alias("asks"), o["end"].alias("end"), F.lit(0).alias("order"),
            F.lit(0).cast("bigint").alias("start"))),
        F.transform(parts, lambda p: F.struct(
            (p["end"] + SCOPE).alias("at"), F.lit(1).alias("asks"), p["end"].alias("end"), p["order"].alias("order"),
            p["start"].alias("start")))))
    never = F.lit(-SCOPE - 1).cast("bigint")

    def met(events: Column) -> Column:
        furthest = running(F.transform(events, lambda e: F.when(e["asks"] == 0, e["end"]).otherwise(never)),
                           lambda a, b: F.greatest(a, b), never)
        return let(furthest, lambda ends: F.filter(events, lambda e, k: (e["asks"] == 1)
                                                   & (F.get(ends, k) >= e["start"] - SCOPE)))

    near = F.transform(let(events, met), lambda e: F.struct(e["start"], e["order"], e["end"]))
    none = F.array().cast(_SPAN)
    return F.when((F.size(parts) > 0) & (F.size(others) > 0), near.cast(_SPAN)).otherwise(none)


def with_spans(docs: DataFrame, out: str, *, text_column: str = "text") -> DataFrame:
    """``docs`` with its spans in the column ``out``: structs of ``start``, ``order`` (the place of
    the kind in ``KINDS``) and ``end``, sorted by start, then kind. A null text has none."""
    text = F.coalesce(quoted(text_column), F.lit(""))
    value = lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 6
    mixed = lambda m: m.rlike("[0-9]") & m.rlike("[a-z]") & m.rlike("[A-Z]")
    names = {k: fresh(docs, f"{k}_parts") for k in (*KINDS, "near")}
    found = docs.withColumns({
        names["assign"]: _spans(text, ASSIGN, "assign", value),
        names["access"]: _spans(text, ACCESS, "access", lambda m: F.length(m) >= 20),
        names["hex"]: _spans(text, HEX, "hex"),
    })
    none = F.array().cast(_SPAN)
    strong = F.size(F.concat(*(F.col(names[k]) for k in BASE))) > 0
    # a weak part is linked to an identifier and a secret at least, of which one can be weak too
    weak_only = text.rlike(IDENT)
    linkable = strong | weak_only
    found = found.withColumns({
        names["ident"]: F.when(linkable, _spans(text, IDENT, "ident")).otherwise(none),
        names["secret"]: F.when(linkable, _spans(text, SECRET, "secret", mixed)).otherwise(none),
        names["endpoint"]: F.when(linkable, _spans(text, ENDPOINT, "endpoint")).otherwise(none),
    })
    identifiers = F.concat(F.col(names["access"]), F.col(names["ident"]))
    secrets = F.concat(F.col(names["assign"]), F.col(names["hex"]), F.col(names["secret"]))
    found = found.withColumn(names["near"], _near(F.col(names["endpoint"]), identifiers))
    linked = F.concat(
        *(F.col(names[k]) for k in BASE),
        _near(F.col(names["ident"]), secrets),
        _near(F.col(names["secret"]), identifiers),
        _near(F.col(names["near"]), secrets),
    )
    return found.withColumn(out, F.array_sort(linked)).drop(*names.values())


def _listed(spans: Column) -> Column:
    kinds = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["order"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` of every row's whole text.

    Null and empty texts have no spans, and the digest of the empty text; a null id stays null;
    repeated rows each give a row; spans of one start go by kind; an empty table gives none; other
    columns are not read.
    """
    rows = docs.select(quoted(id_column).alias("doc_id"), quoted(text_column).alias("text"))
    rows = with_spans(rows, "found").select("doc_id", "found")

    def number(kind: str) -> Column:
        order = KINDS.index(kind)
        return F.size(F.filter("found", lambda s: s["order"] == order)).cast("long").alias(f"n_{kind}")

    base = F.filter("found", lambda s: s["order"] < len(BASE))
    return rows.select(
        "doc_id", *(number(k) for k in BASE),
        F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"), _listed(F.col("found")).alias("spans"))


def masked(docs: DataFrame, *, text_column: str = "text", length_column: str = "n_chars") -> DataFrame:
    """``docs`` with every span of its texts replaced by ``MASK``, overlapping spans by one; a
    ``length_column``, where there is one, is the new text's length. Texts without spans stay."""
    spans, text = fresh(docs, "spans"), quoted(text_column)
    found = with_spans(docs, spans, text_column=text_column)
    # spans that overlap are one stretch: it begins where a span starts beyond all ends before it
    zero = F.lit(-1).cast("bigint")
    ends = running(F.transform(spans, lambda s: s["end"]), lambda a, b: F.greatest(a, b), zero)

    def replaced(ends: Column) -> Column:
        firsts = F.filter(F.sequence(F.lit(0), F.size(spans) - 1), lambda k: (k == 0) | (
            F.get(F.col(spans), k)["start"] >= F.get(ends, k - 1)))
        return let(firsts, lambda firsts: let(
            F.transform(firsts, lambda k: F.get(F.col(spans), k)["start"]), lambda starts: let(
                pieces(text, F.concat(F.array(F.lit(0).cast("bigint")), starts)), lambda cut: F.array_join(
                    F.transform(cut, lambda p, i: F.when(i == 0, p).otherwise(F.concat(F.lit(MASK), F.substring(
                        p, (F.get(ends, F.coalesce(F.get(firsts, i), F.size(spans)) - 1)
                            - F.get(starts, i - 1) + 1).cast("int"), F.length(p))))), ""))))

    has = F.size(spans) > 0
    out = found.withColumn(text_column, F.when(has, let(ends, replaced)).otherwise(text))
    if length_column in docs.columns:
        kind = docs.schema[length_column].dataType
        out = out.withColumn(length_column, F.when(has, F.length(text).cast(kind)).otherwise(
            quoted(length_column)))
    return out.drop(spans)
