"""Carry unit numbers over from last month's links (``old``) to this month's (``new``).

A rule says which old and new links are the same unit. Its matches hold the new link's content
under the old link's number. A rule on its own gives every matching pair; ``one_to_one``, which the
jobs and ``assign_ids`` set by default, keeps the lowest number of each new link, and then reduces
the old side to one row per key before the join, so that a key shared by many links on both sides
costs no more than its rows. The pair form is for keys that few links share: N old and M new links
of one key are N x M rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkindex.operators.numbering import (
    CHUNK,
    allocate_dense_ids,
    allocate_ids_in_order,
    max_ubrn,
)
from linkindex.schemas import CH, PAYE, VAT
from linkindex.sources.readers import as_large
from linkindex.sources.staging import stage

CONTENT = [CH, VAT, PAYE]
DEFAULT_RULES = ("key",)
ALL_RULES = ("key", "content", "vat", "paye")
Rule = Callable[[DataFrame, DataFrame, bool], DataFrame]
Written = Callable[[DataFrame], DataFrame]
# Old and new links of one reference that a task pairs at a time; more are dealt over several tasks.
OLD_PIECE, NEW_PIECE = 1 << 14, 512
# Numbers that a row brings to the pairs of a reference which more old links share.
NUMBERS_A_ROW = 1024
# Bytes of a link that meets numbers one at a time: all pairs of a row are kept until it ends.
WIDE = 1 << 14
# References of both sides that a task compares, about; more are dealt over more tasks.
REFS_A_TASK = 1 << 19


@dataclass(frozen=True)
class Matches:
    """What a rule found, and what is left of either side."""

    matched: DataFrame
    unmatched_new: DataFrame
    unmatched_old: DataFrame


def without_blanks(links: DataFrame) -> DataFrame:
    """Links to match on: blank references dropped, an array left without any becomes null."""
    kept = {c: F.filter(c, lambda r: r != "") for c in CONTENT}
    return links.withColumns({c: F.when(F.size(a) > 0, a) for c, a in kept.items()})


def with_gid(new: DataFrame) -> DataFrame:
    """New links with a row key, staged so that the key never changes again."""
    return stage(new.withColumn("GID", F.monotonically_increasing_id()), "new-links")


def _has_company() -> Column:
    return F.col(CH).isNotNull() & F.get(CH, F.lit(0)).isNotNull()


def _match_on(
    old: DataFrame, new: DataFrame, cols: list[str], valid: Column, one_to_one: bool
) -> DataFrame:
    """Pairs of valid links with equal ``cols``: the new link under the old number."""
    numbers = old.where(valid).select("UBRN", *cols)
    if one_to_one:
        numbers = numbers.groupBy(*cols).agg(F.min("UBRN").alias("UBRN"))
    return new.drop("UBRN").where(valid).join(as_large(numbers), cols).select("UBRN", *_content(new))


def _content(new: DataFrame) -> list[str]:
    return [c for c in ("GID", *CONTENT) if c in new.columns]


def rule_id(old: DataFrame, new: DataFrame, one_to_one: bool = False) -> DataFrame:
    """New links that bring a number which is in use, once per old link that has it."""
    held = old.where(F.col("UBRN").isNotNull()).select("UBRN")
    how = "left_semi" if one_to_one else "inner"
    return new.where(F.col("UBRN").isNotNull()).join(as_large(held), "UBRN", how).select(
        "UBRN", *_content(new)
    )


def rule_company(old: DataFrame, new: DataFrame, one_to_one: bool = False) -> DataFrame:
    """Equal company arrays with a first element (a blank one is a value like any other)."""
    return _match_on(old, new, [CH], _has_company(), one_to_one)


def rule_content(old: DataFrame, new: DataFrame, one_to_one: bool = False) -> DataFrame:
    """No company on either side, equal VAT arrays and equal PAYE arrays."""
    valid = (
        F.get(CH, F.lit(0)).isNull() & F.col(VAT).isNotNull() & F.col(PAYE).isNotNull()
    )
    return _match_on(old, new, [VAT, PAYE], valid, one_to_one)


def rule_reference(
    old: DataFrame, new: DataFrame, col: str, one_to_one: bool = False, written: Written | None = None
) -> DataFrame:
    """Links sharing a reference that is the lowest shared one of both.

    ``written`` gives new links the form in which their content comes out, once a link and not once a pair.
    """
    tasks = _reference_tasks(old, new, col)
    shown = written(new) if written else new
    if one_to_one:
        return _with_content(_reference_pairs(old, new, col, tasks), shown)
    return _pair_up(*_reference_sides(old, new, col, tasks), shown)


def _with_content(pairs: DataFrame, new: DataFrame) -> DataFrame:
    return as_large(pairs).join(new.select(*_content(new)), "GID").select("UBRN", *_content(new))


def _reference_tasks(old: DataFrame, new: DataFrame, col: str) -> int:
    """Over how many tasks the references of two sides are dealt, so that none has more as they grow."""
    held = [links.agg(F.sum(F.array_size(col))).first()[0] or 0 for links in (old, new)]
    usual = int(new.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # with fewer Spark deals them anew
    return max(usual, 1 + sum(held) // REFS_A_TASK)


def _references(
    old: DataFrame, new: DataFrame, col: str, tasks: int
) -> tuple[DataFrame, DataFrame]:
    """The references that both sides have, by number and by row key.

    They are nearly all different, so they are dealt as they are: to drop repeats first, each task would
    hold all of its references. The number of tasks is given, as Spark would merge them by their
    compressed size.
    """
    old_refs = old.where(F.col("UBRN").isNotNull()).select("UBRN", F.explode(col).alias("_ref"))
    new_refs = new.select("GID", F.explode(col).alias("_ref"))
    old_refs, new_refs = old_refs.repartition(tasks, "_ref"), new_refs.repartition(tasks, "_ref")
    return _shared(old_refs, new_refs), _shared(new_refs, old_refs)


def _reference_pairs(old: DataFrame, new: DataFrame, col: str, tasks: int) -> DataFrame:
    """``(UBRN, GID)`` of the reference rule, the lowest number of each new link.

    The lowest shared reference of a link needs no pairs: it is the lowest of its references that
    the other side has at all.
    """
    old_shared, new_shared = _references(old, new, col, tasks)
    lowest = old_shared.groupBy("UBRN").agg(F.min("_ref").alias("_ref"))
    numbers = lowest.groupBy("_ref").agg(F.min("UBRN").alias("UBRN"))
    pairs = new_shared.groupBy("GID").agg(F.min("_ref").alias("_ref"))
    return pairs.join(as_large(numbers), "_ref").select("UBRN", "GID")


def _reference_sides(
    old: DataFrame, new: DataFrame, col: str, tasks: int
) -> tuple[DataFrame, DataFrame]:
    """``(UBRN, _ref, _old)`` and ``(GID, _ref, _new)``: links with their lowest shared reference and how
    many times they hold it, of the references that are the lowest one on both sides.

    They stand for all pairs of the reference rule in as many rows as there are links.
    """
    old_shared, new_shared = _references(old, new, col, tasks)
    numbers = stage(_lowest(old_shared, "UBRN", "_old"), f"lowest-{col}-old")
    rows = stage(_lowest(new_shared, "GID", "_new"), f"lowest-{col}-new")
    return (
        stage(_shared(numbers, rows), f"sides-{col}-old"),
        stage(_shared(rows, numbers), f"sides-{col}-new"),
    )


def _pair_up(numbers: DataFrame, rows: DataFrame, new: DataFrame) -> DataFrame:
    """All pairs of two sides, the new link's content under the old number.

    The content meets the rows, not the pairs, which so go through no shuffle. The pairs of a reference
    that very many links share are dealt over tasks: its old and new links are cut into pieces, and each
    piece meets all of the other side's. Of such a reference a row brings many numbers, and pairs are made
    by taking them apart; only links that are wide or hold it several times meet its numbers one at a time.
    """
    wide = F.octet_length(F.concat_ws(",", *CONTENT)) > WIDE
    rows = rows.join(as_large(new.select("GID", wide.alias("_wide"))), "GID")
    rows = rows.withColumn("_singly", F.col("_wide") | (F.col("_new") > 1))
    cut = _pieces(numbers, rows)
    cut = F.broadcast(cut.where((F.col("_slots") > 1) | (F.col("_news") > 1)))  # of hot references only
    partitions = int(new.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = ["_ref", "_old_piece", "_new_piece", "_single"]
    olds = _gathered(numbers.join(cut, "_ref", "left")).withColumn(
        "_new_piece", F.explode(_all_pieces("_news"))
    )
    news = rows.join(cut, "_ref", "left").withColumns(
        {"_new_piece": _piece("GID", "_news"), "_old_piece": F.explode(_all_pieces("_olds")),
         "_single": F.col("_singly") & _in_both_forms()}
    ).join(as_large(new.select(*_content(new))), "GID")
    # Few rows may stand for very many pairs, so their number of partitions is given.
    olds = olds.select("_numbers", "_old", *place).repartition(partitions, *place)
    news = news.select(*_content(new), "_new", *place).repartition(partitions, *place)
    pairs = news.join(as_large(olds), place)
    uses = (F.col("_old") * F.col("_new")).alias("_uses")
    pairs = _repeat(pairs.select("_numbers", *_content(new), uses), "_uses")
    return pairs.select(F.explode("_numbers").alias("UBRN"), *_content(new))


def _pieces(numbers: DataFrame, rows: DataFrame) -> DataFrame:
    """Into how many pieces each reference's old and new links are cut, over how many rows its numbers are
    dealt, and whether a new link takes them singly: one count of both, no join."""
    olds = numbers.select("_ref", F.lit(1).alias("_olds"), F.lit(0).alias("_news"), F.lit(False).alias("_singly"))
    news = rows.select("_ref", F.lit(0).alias("_olds"), F.lit(1).alias("_news"), "_singly")
    return olds.unionByName(news).groupBy("_ref").agg(
        F.ceil(F.sum("_olds") / OLD_PIECE).alias("_olds"),
        F.ceil(F.sum("_news") / NEW_PIECE).alias("_news"),
        F.ceil(F.sum("_olds") / min(OLD_PIECE, NUMBERS_A_ROW)).alias("_slots"),
        F.max("_singly").alias("_by_one"),
    )


def _gathered(numbers: DataFrame) -> DataFrame:
    """Numbers of a hot reference many to a row, but those of links that hold it several times; where a new
    link needs it, every number once more by itself. Others are a row each."""
    numbers = numbers.withColumn("_slot", F.when(
        (_count("_slots") > 1) & (F.col("_old") == 1), F.pmod(F.xxhash64("UBRN"), "_slots")))
    alone = numbers.where(F.col("_slot").isNull()).select(
        "_ref", "_old", "_news", _in_both_forms().alias("_both"), F.array("UBRN").alias("_numbers"),
        _piece("UBRN", "_olds").alias("_old_piece"))
    many = numbers.where(F.col("_slot").isNotNull()).groupBy(
        "_ref", "_old", "_news", _in_both_forms().alias("_both"), "_slot", "_olds"
    ).agg(F.collect_list("UBRN").alias("_numbers"))
    many = many.withColumn("_old_piece", F.pmod("_slot", "_olds")).select(*alone.columns)
    whole = F.array(F.struct(F.lit(False).alias("_single"), "_numbers"))
    one_by_one = F.transform("_numbers", lambda n: F.struct(F.lit(True).alias("_single"), F.array(n).alias("_numbers")))
    forms = F.when(F.col("_both"), F.concat(whole, one_by_one)).otherwise(whole)
    rest = ["_ref", "_old", "_news", "_old_piece"]
    return alone.unionByName(many).select(*rest, F.inline(forms))


def _in_both_forms() -> Column:
    """Whether numbers of a reference come many to a row and also one by one."""
    return F.coalesce((F.col("_slots") > 1) & F.col("_by_one"), F.lit(False))


def _count(pieces: str) -> Column:
    return F.coalesce(pieces, F.lit(1).cast("bigint"))


def _piece(unit: str, pieces: str) -> Column:
    return F.pmod(F.xxhash64(unit), _count(pieces))


def _all_pieces(pieces: str) -> Column:
    return F.sequence(F.lit(0).cast("bigint"), _count(pieces) - 1)


def _shared(refs: DataFrame, other: DataFrame) -> DataFrame:
    """The references the other side has too."""
    return refs.join(as_large(other.select("_ref")), "_ref", "left_semi")


def _lowest(shared: DataFrame, unit: str, times: str) -> DataFrame:
    """Per unit its lowest shared reference, and how many times the unit holds that one."""
    held = shared.groupBy(unit, "_ref").agg(F.count(F.lit(1)).alias(times))
    return held.groupBy(unit).agg(F.min(F.struct("_ref", times)).alias("m")).select(unit, "m.*")


def _repeat(df: DataFrame, times: str) -> DataFrame:
    """Each row as many times as its ``times`` column says, a chunk of copies at a time."""
    rest = [c for c in df.columns if c != times]
    copies = F.col(times)
    chunks = df.select(*rest, copies, F.explode(_steps(F.lit(1), copies, CHUNK)).alias("_from"))
    last = F.least(copies, F.col("_from") + (CHUNK - 1))
    return chunks.select(*rest, F.explode(_steps(F.col("_from"), last, 1))).select(*rest)


def _steps(first: Column, last: Column, step: int) -> Column:
    return F.sequence(first.cast("bigint"), last, F.lit(step).cast("bigint"))


def exclude_matched(old: DataFrame, new: DataFrame, matched: DataFrame) -> Matches:
    """Old links whose number and new links whose row key no match used."""
    return Matches(
        matched,
        _without(new, matched, "GID"),
        _without(old.where(F.col("UBRN").isNotNull()), matched, "UBRN"),
    )


def _without(links: DataFrame, used: DataFrame, col: str) -> DataFrame:
    return links.join(as_large(used.select(col).distinct()), col, "left_anti")


def _key_rule(new: DataFrame) -> Rule:
    """A batch that brings numbers is matched on them, any other on its companies."""
    return rule_id if "UBRN" in new.columns else rule_company


def _pairs(name: str, old: DataFrame, new: DataFrame, one_to_one: bool) -> DataFrame:
    """``(UBRN, GID)`` of a rule on keys; the content is pruned from the joins that find them."""
    rule = rule_content if name == "content" else _key_rule(new)
    return rule(old, new, one_to_one).select("UBRN", "GID")


def _apply_key_rule(new: DataFrame, old: DataFrame, one_to_one: bool):
    """The key rule alone: its unmatched links are those whose key the other side lacks.

    Links without a key cannot match, so they go around the join.
    """
    matched = _key_rule(new)(old, new, one_to_one)
    if "UBRN" in new.columns:
        key, has_key = "UBRN", F.col("UBRN").isNotNull()
    else:
        key, has_key = CH, _has_company()
    used = old.where(has_key).select(key).distinct()
    rest = new.where(has_key).join(as_large(used), key, "left_anti")
    without_key = new.where(~has_key).select(*_content(new))
    rest = rest.select(*_content(new)).unionByName(without_key)
    return matched.select("UBRN", *CONTENT), rest


def apply_rules(
    new: DataFrame,
    old: DataFrame,
    rules: Sequence[str] = DEFAULT_RULES,
    one_to_one: bool = True,
    blanks_match: bool = True,
    written: Written | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Run the rules in order, each on what the ones before left: (matched, need a number).

    Of a rule only what it found is staged, as numbers and row keys; of a reference rule without
    ``one_to_one`` the two sides of its pairs. What is left for the next one are
    the links without those keys, in the columns it matches on: two anti-joins with narrow tables, no
    copy of the links. The content is fetched once, after the last rule, as it came: also where
    ``blanks_match`` is off and the rules do not see its blanks. ``written`` gives the matched links the
    form in which their content comes out.
    """
    written = written or _as_it_is
    unknown = [name for name in rules if name not in ALL_RULES]
    if unknown or not rules:
        raise ValueError(f"unknown rules {unknown}; known: {', '.join(ALL_RULES)}")
    if tuple(rules) == ("key",) and blanks_match:
        matched, rest = _apply_key_rule(new, old, one_to_one)
        return written(matched), rest
    keyed = new if "GID" in new.columns else with_gid(new)
    from_new, from_old = keyed, old
    if not blanks_match:
        from_new, from_old = without_blanks(keyed), without_blanks(old)
    found, sides = [], []
    numbers_used, rows_used = [], []
    for name in rules:
        rest_new, rest_old = from_new, from_old
        if numbers_used:
            rest_old = _without(from_old.where(F.col("UBRN").isNotNull()), _all(numbers_used), "UBRN")
            rest_new = _without(from_new, _all(rows_used), "GID")
        used = _used_by(name, keyed)
        rest_old, rest_new = _only(rest_old, {"UBRN", *used}), _only(rest_new, {"GID", *used})
        of_refs = name in ("vat", "paye")
        tasks = _reference_tasks(from_old, from_new, name.upper()) if of_refs else 0  # no join, so an upper bound
        if of_refs and not one_to_one:
            numbers, rows = _reference_sides(rest_old, rest_new, name.upper(), tasks)
            sides.append((numbers, rows))
        else:
            pairs = (_reference_pairs(rest_old, rest_new, name.upper(), tasks) if of_refs
                     else _pairs(name, rest_old, rest_new, one_to_one))
            numbers = rows = stage(pairs, f"pairs-{name}")
            found.append(numbers)
        numbers_used.append(numbers.select("UBRN"))
        rows_used.append(rows.select("GID"))
    shown = written(keyed)
    matched = [_pair_up(numbers, rows, shown) for numbers, rows in sides]
    if found:
        matched.append(_with_content(_all(found), shown))
    rest = _without(keyed, _all(rows_used), "GID")
    return _all(matched).select("UBRN", *CONTENT), rest.select(*_content(keyed))


def _as_it_is(links: DataFrame) -> DataFrame:
    return links


def _all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _used_by(rule: str, new: DataFrame) -> list[str]:
    """The columns that a rule looks at."""
    if rule == "key":
        return ["UBRN"] if "UBRN" in new.columns else [CH]
    return CONTENT if rule == "content" else [rule.upper()]


def _only(links: DataFrame, columns: set[str]) -> DataFrame:
    return links.select(*[c for c in links.columns if c in columns])


def combine_links(carried: DataFrame, numbered: DataFrame) -> DataFrame:
    """Carried-over and newly numbered links in one frame."""
    cols = ["UBRN", *CONTENT]
    return carried.select(*cols).unionByName(numbered.select(*cols))


def assign_ids(
    new: DataFrame,
    prev: DataFrame,
    rules: Sequence[str] = DEFAULT_RULES,
    one_to_one: bool = True,
    blanks_match: bool = True,
    high_water: int | None = None,
    input_order: bool = False,
    written: Written | None = None,
) -> DataFrame:
    """Match the new links to the previous ones and number the rest after the highest number.

    New numbers go by the links' content, or with ``input_order`` by ``_file`` and ``_row`` of the
    new links, which ``readers.read_in_order`` takes from their files. ``high_water`` is the highest
    number ever issued, if it may exceed those in ``prev``. Without ``blanks_match`` a blank
    reference matches nothing; it is written as it came. ``written`` gives links the form in which their
    content comes out, before pairs of them are made.
    """
    written = written or _as_it_is
    if new.isEmpty():
        raise ValueError("the batch of new links is empty")
    if input_order:
        new = with_gid(new)
        places = new.select("GID", "_file", "_row")
        new = new.drop("_file", "_row")
    carried, rest = apply_rules(new, prev, rules, one_to_one, blanks_match, written)
    base = max_ubrn(prev).scalar()
    if high_water is not None:
        base = F.greatest(base, F.lit(high_water).cast("bigint"))
    if input_order:
        return combine_links(carried, written(allocate_ids_in_order(rest.join(places, "GID"), base)))
    return combine_links(carried, written(allocate_dense_ids(rest.select(*CONTENT), base)))
