"""What must hold when one key has a third of all rows, and what the plans must look like."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from contextlib import contextmanager

import pytest
from frames import B, bag, company, links, paye, raw_links, tcn, vat
from pyspark.sql import functions as F

from linkindex.demo import adapters, catalogue
from linkindex.operators import extracts, linking, matching, views
from linkindex.operators.numbering import allocate_dense_ids
from linkindex.plans.jobs import index_from
from linkindex.schemas import ADMIN_SCHEMAS, CH, INDEX, PAYE, TCN, VAT
from linkindex.sources import readers
from linkindex.sources.staging import stage


@contextmanager
def settings(spark, **values):
    names = {k: k.replace("_", ".") for k in values}
    before = {n: spark.conf.get(n) for n in names.values()}
    try:
        for k, n in names.items():
            spark.conf.set(n, values[k])
        yield
    finally:
        for n, value in before.items():
            spark.conf.set(n, value)


def small_cluster(spark):
    """Thresholds lowered so that a test's few rows are treated like a cluster's many."""
    return settings(
        spark,
        spark_sql_autoBroadcastJoinThreshold="-1",
        spark_sql_adaptive_skewJoin_skewedPartitionThresholdInBytes="2KB",
        spark_sql_adaptive_skewJoin_skewedPartitionFactor="2",
        spark_sql_adaptive_advisoryPartitionSizeInBytes="1KB",
        spark_sql_adaptive_coalescePartitions_enabled="false",
    )


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def hot_links(spark, n=6000):
    """A third of the links name one company and one VAT record."""
    hot = F.col("id") % 3 == 0
    return stage(
        spark.range(n, numPartitions=8).select(
            (F.col("id") + B).alias("UBRN"),
            F.array(F.when(hot, "HOT").otherwise(F.concat(F.lit("c"), "id"))).alias("CH"),
            F.array(F.when(hot, "7").otherwise((F.col("id") + 100).cast("string"))).alias("VAT"),
            F.array(F.md5(F.col("id").cast("string"))).alias("PAYE"),
        ),
        "hot-links",
    )


def test_hot_key_is_split(spark):
    n = 6000
    with small_cluster(spark):
        view = views.link_view(hot_links(spark, n))
        records = company(
            spark, {"CompanyNumber": "HOT"}, *[{"CompanyNumber": f"c{i}"} for i in range(0, n, 2)]
        )
        joined = linking.join_company(view, views.company_view(stage(records, "companies")))
        got = Counter(r.key for r in joined.select("*").collect())
        run = joined.select("*")
        run.collect()
        assert "skew=true" in plan(run)
    assert got == Counter(
        "HOT" if i % 3 == 0 else f"c{i}" for i in range(n) if i % 3 == 0 or i % 2 == 0
    )


def test_hot_records_in_the_index(spark):
    """A third of the units share a company and a VAT record; all of them get both."""
    n = 6000
    with small_cluster(spark):
        records = [{"vatref": i, "name1": "n", "turnover": 10} for i in (7, *range(100, 100 + n, 2))]
        index = index_from(
            hot_links(spark, n),
            stage(company(spark, {"CompanyNumber": "HOT", "CompanyName": "hot"}), "companies"),
            stage(vat(spark, *records), "vats"),
            paye(spark),
            tcn(spark),
        ).select("id", "BusinessName", "VatRefs")
        rows = {r.id - B: (r.BusinessName, r.VatRefs) for r in index.collect()}
        assert "skew=true" in plan(index)
    assert rows == {
        i: ("HOT", [7]) if i % 3 == 0 else ("N  ", [i + 100])
        for i in range(n)
        if i % 3 == 0 or i % 2 == 0
    }


def test_hot_company_is_carried_over(spark):
    """A third of the new links share a company: the matching and the anti join are split."""
    n = 6000
    with small_cluster(spark):
        new = hot_links(spark, n).drop("UBRN")
        prev = stage(links(spark, (B + 5, ["HOT"], None, None), (B + 6, ["c1"], None, None)), "p")
        got = matching.assign_ids(new, prev, one_to_one=False).select("*")
        rows = got.collect()
        assert "skew=true" in plan(got)
    numbers = Counter(r.UBRN for r in rows)
    assert numbers.pop(B + 5) == n // 3
    assert numbers.pop(B + 6) == 1
    rest = n - n // 3 - 1
    assert sorted(numbers) == list(range(B + 7, B + 7 + rest))


def test_hot_unit(spark):
    """A third of the links have no number and so make up one unit."""
    n = 1500
    rows = [(None if i % 3 == 0 else B + i, None, [str(i), str(i + 1)], None) for i in range(n)]
    records = [{"vatref": i, "turnover": i, "name1": f"n{i}"} for i in range(1, n)]
    with small_cluster(spark):
        index = index_from(
            links(spark, *rows), company(spark), vat(spark, *records), paye(spark), tcn(spark)
        )
        got = {r.id: r for r in index.collect()}
    refs = defaultdict(list)
    for ubrn, _, vats, _ in rows:
        found = [(pos, int(v)) for pos, v in enumerate(vats) if 1 <= int(v) < n]
        refs[1 if ubrn is None else ubrn] += found
    expected = {u: [v for _, v in sorted(found)] for u, found in refs.items() if found}
    assert {u: r.VatRefs for u, r in got.items()} == expected
    assert all(r.BusinessName == f"N{expected[u][0]}  " for u, r in got.items())


def test_one_to_one_makes_no_pairs(spark):
    """A blank company on both sides of every link: rows out as many as rows in."""
    n = 4000
    blank = spark.range(n).select(
        F.array(F.lit("")).alias("CH"),
        F.array(F.lit("")).alias("VAT"),
        F.array(F.col("id").cast("string")).alias("PAYE"),
    )
    prev = stage(blank.withColumn("UBRN", F.monotonically_increasing_id() + B), "prev")
    new = stage(blank, "new")
    for rules in (("key",), ("vat", "key")):
        got = matching.assign_ids(new, prev, rules=rules, one_to_one=True)
        assert bag(got.groupBy("UBRN").count()) == [(B, n)]


def test_hot_copies(spark):
    """A third of the rows to be numbered are the same row."""
    rows = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("n"))
    numbered = allocate_dense_ids(rows, F.lit(0).cast("bigint"))
    assert sorted(r[0] for r in numbered.collect()) == list(range(1, 3001))
    # the copies are counted before any row is moved
    steps = plan(numbered)
    first_exchange = steps.rindex("Exchange hashpartitioning(n")
    assert "partial_count" in steps[first_exchange:]


@pytest.fixture(scope="module")
def sources(spark):
    empty = {src: spark.createDataFrame([], schema) for src, schema in ADMIN_SCHEMAS.items()}
    return {src: stage(df, src) for src, df in empty.items()}


def test_index_plan(spark, sources):
    with small_cluster(spark):
        index = index_from(
            stage(links(spark, (1, ["a"], ["1"], ["p"])), "l"),
            sources[CH], sources[VAT], sources[PAYE], sources[TCN],
        )
        steps = plan(index)
        flat = plan(extracts.legal_entities(index))
    # the flat extract builds no arrays
    assert "collect_list" in steps
    assert "collect_list" not in flat
    # filters and column lists reach the files
    assert "PushedFilters: [IsNotNull(CompanyNumber)" in steps
    assert "PushedFilters: [IsNotNull(vatref)" in steps
    assert "PushedFilters: [IsNotNull(payeref)" in steps
    for column in ("MortgagesNumMortCharges", "turnover_date", "employer_cat"):
        assert column not in steps
    # one shuffle by unit, after a partial aggregate; nothing in Python, no products
    assert steps.count("Exchange hashpartitioning(UBRN") == 1
    assert "partial_min(ch" in steps
    for word in ("Python", "Cartesian", "NestedLoop", "SinglePartition", "BroadcastExchange"):
        assert word not in steps, word


def test_extract_plans_move_no_rows(spark):
    index = stage(spark.createDataFrame([], INDEX), "index")
    for build in (extracts.legal_entities, extracts.legal_entities_with_refs, extracts.vat_refs):
        assert "Exchange" not in plan(build(index))
    assert "PayeRefs" not in plan(extracts.vat_refs(index))


def test_matching_plan(spark):
    with small_cluster(spark):
        new = stage(raw_links(spark, (["a"], ["v"], None)), "n")
        prev = stage(links(spark, (B + 1, ["a"], None, None)), "p")
        steps = plan(matching.assign_ids(new, prev))
    for word in ("Python", "Cartesian", "NestedLoop"):
        assert word not in steps, word
    # one task sees only: the highest number, and the row counts of at most 16**4 buckets
    assert steps.count("Exchange SinglePartition") <= 3
    assert "BroadcastExchange" in steps


def test_narrow_columns_of_a_long_table_are_not_broadcast(spark):
    """A file's few columns look small, whatever its rows: the default threshold must not matter."""
    held = stage(links(spark, (1, ["a"], ["1"], ["p"])), "l")
    vats, payes = stage(vat(spark, {"vatref": 1}), "v"), stage(paye(spark, {"payeref": "p"}), "p")
    view = views.link_view(held)
    joined = linking.join_vat(view, views.vat_view(vats))
    assert "Broadcast" not in plan(joined.select("UBRN", "turnover"))
    of_paye = linking.join_paye(view, payes.select(F.col("payeref").alias("key")))
    assert "Broadcast" not in plan(of_paye)
    readers.register_views(long_links=held, long_vat=vats)
    found = spark.sql("""SELECT count(*) AS n FROM (SELECT explode(VAT) AS ref FROM long_links) l
        JOIN long_vat ON CAST(vatref AS STRING) = l.ref""")
    assert "Broadcast" not in plan(found)
    assert found.collect()[0].n == 1


def test_matching_broadcasts_no_links(spark):
    new = stage(links(spark, (B + 1, ["a"], None, None)), "n")
    prev = stage(links(spark, (B + 1, ["a"], None, None)), "p")
    for one_to_one in (False, True):
        for rule in (matching.rule_id, matching.rule_company):
            assert "Broadcast" not in plan(rule(prev, new, one_to_one))
    left = matching.exclude_matched(prev, matching.with_gid(new), matching.with_gid(new))
    assert "Broadcast" not in plan(left.unmatched_old) + plan(left.unmatched_new)


def test_pairs_of_a_hot_reference_are_dealt_and_not_staged(spark, monkeypatch):
    """Twenty old and thirty new links share a blank, some hold it twice: all pairs, of few staged rows."""
    prev = links(spark, *[(B + i, None, [""] * (1 + i % 2), None) for i in range(20)],
                 (B + 50, None, ["7"], None))
    new = raw_links(spark, *[([f"n{i}"], ["", "9"] if i else ["", ""], None) for i in range(30)],
                    (["m"], ["7"], None))
    monkeypatch.setattr(matching, "OLD_PIECE", 3)
    monkeypatch.setattr(matching, "NEW_PIECE", 2)
    written = []

    def staged(df, name):
        written.append(stage(df, name))
        return written[-1]

    monkeypatch.setattr(matching, "stage", staged)
    carried, rest = matching.apply_rules(new, prev, ("vat",), one_to_one=False)
    got = Counter((r.UBRN, r.CH[0]) for r in carried.collect())
    expected = Counter({(B + i, f"n{j}"): (1 + i % 2) * (1 if j else 2)
                        for i in range(20) for j in range(30)})
    expected[B + 50, "m"] = 1
    assert got == expected
    assert rest.count() == 0
    assert max(df.count() for df in written) <= 31  # rows of links, not of pairs
    # the pairs are made after the last shuffle
    steps = plan(carried)
    assert "Exchange" not in steps[:steps.index("SortMergeJoin")]


def test_numbers_of_a_hot_reference_come_many_to_a_row(spark, monkeypatch):
    """Forty old and thirty new links share a blank: pairs are taken out of rows of many numbers, whose links are
    narrow and hold it once."""
    times = {i: 3 if i == 7 else 1 for i in range(40)}
    prev = links(spark, *[(B + i, None, [""] * n, None) for i, n in times.items()],
                 (B + 50, None, ["7"], None), (B + 51, None, ["7", "8"], None))
    wide = ["w" * 500]
    new = raw_links(spark, *[([f"n{i}"], ["", "" if i == 3 else "9"], wide if i == 5 else None) for i in range(30)],
                    (["m"], ["7", "7"], wide), (None, ["5"], None))
    for name, value in {"NUMBERS_A_ROW": 8, "OLD_PIECE": 16, "NEW_PIECE": 4, "WIDE": 100}.items():
        monkeypatch.setattr(matching, name, value)
    met, repeat = [], matching._repeat
    monkeypatch.setattr(matching, "_repeat", lambda df, times: met.append(df) or repeat(df, times))
    found = matching.rule_reference(prev, matching.with_gid(new), VAT, written=catalogue._texts)
    expected = Counter({(B + i, f"n{j}", "," if j == 3 else ",9"): n * (2 if j == 3 else 1)
                        for i, n in times.items() for j in range(30)})
    expected |= Counter({(B + i, "m", "7,7"): 2 for i in (50, 51)})
    assert Counter((r.UBRN, r.CH, r.VAT) for r in found.collect()) == expected
    rows = met[0].select("CH", "_uses", F.size("_numbers").alias("n")).collect()
    sizes = defaultdict(list)
    for r in rows:
        sizes[r.CH].append(r.n)
        assert r.n == 1 or r._uses == 1
    for j in range(30):
        assert sum(sizes[f"n{j}"]) == 40
        assert len(sizes[f"n{j}"]) == 40 if j in (3, 5) else len(sizes[f"n{j}"]) <= 6  # five rows and the link of three
    assert sizes["m"] == [1, 1]


def test_pairs_take_texts_made_once_a_link(spark, monkeypatch):
    prev = stage(links(spark, (B + 1, None, ["", "1"], ["p"]), (B + 2, None, [""], ["q"])), "prev")
    new = stage(raw_links(spark, (["a"], ["", "2"], None), (["b"], ["", "3"], None), (["c"], None, ["q"])), "new")
    tables = {"prev_links": prev, "new_links": new}
    monkeypatch.setattr(catalogue.Tables, "of", lambda spark, folder: tables)
    pairs = {(B + i, c, v) for i in (1, 2) for c, v in (("a", ",2"), ("b", ",3"))}
    for name in ("match_by_vat", "assign_ids_full"):
        found = catalogue.QUERIES[name](spark, "nowhere")
        steps = plan(found)
        assert "array_join" in steps
        assert "array_join" not in steps[:steps.index("SortMergeJoin")]
        assert {(r.UBRN, r.CH, r.VAT) for r in found.collect() if r.CH != "c"} == pairs


def test_references_are_compared_by_more_tasks_as_they_grow(spark, monkeypatch):
    """However many references: a task holds no set of those it reads, and compares a bounded number."""
    n, each = 60, 20
    held = spark.range(n).select(  # some a blank, one reference twice, five shared with the next
        F.array(F.concat(F.lit("c"), "id")).alias("CH"),
        F.concat(F.when(F.col("id") < 5, F.array(F.lit(""))).otherwise(F.array().cast("array<string>")),
                 F.transform(F.sequence(F.lit(1), F.lit(each)), lambda i: F.format_string("%06d", F.col("id") * 15 + i)),
                 F.array(F.format_string("%06d", F.col("id") * 15 + 1))).alias("PAYE"),
    )
    prev = stage(held.select((F.col("CH")[0].substr(2, 9).cast("long") + B).alias("UBRN"), "CH",
                             F.lit(None).cast("array<string>").alias("VAT"), "PAYE").where("UBRN % 2 = 0"), "prev")
    new = matching.with_gid(held.select("CH", F.lit(None).cast("array<string>").alias("VAT"), "PAYE"))
    rows = {"old": prev.select("UBRN", "PAYE").collect(), "new": new.select("CH", "PAYE").collect()}
    total = sum(len(r.PAYE) for side in rows.values() for r in side)
    lowest = {}
    for side, other in (("old", "new"), ("new", "old")):
        there = {ref for r in rows[other] for ref in r.PAYE}
        for r in rows[side]:
            ref = min((ref for ref in r.PAYE if ref in there), default=None)
            lowest[r[0] if side == "old" else r.CH[0]] = (ref, r.PAYE.count(ref))
    expected = Counter({(o.UBRN, m.CH[0]): lowest[o.UBRN][1] * lowest[m.CH[0]][1] for o in rows["old"]
                        for m in rows["new"] if lowest[o.UBRN][0] is not None and lowest[o.UBRN][0] == lowest[m.CH[0]][0]})
    monkeypatch.setattr(matching, "REFS_A_TASK", 100, raising=False)
    steps = {}

    def staged(df, name):
        steps[name] = plan(df)
        return stage(df, name)

    monkeypatch.setattr(matching, "stage", staged)
    got = Counter((r.UBRN, r.CH[0]) for r in matching.rule_reference(prev, new, PAYE).collect())
    assert got == expected
    for name in ("lowest-PAYE-old", "lowest-PAYE-new"):
        dealt = re.findall(r"Exchange hashpartitioning\(_ref#\d+, (\d+)\)", steps[name])
        assert dealt == [str(1 + total // 100)] * 2
        assert "REPARTITION_BY_NUM" in steps[name]  # so Spark does not merge them
        # what reads the references makes no sets of them
        assert "Aggregate" not in _below(steps[name], "SortMergeJoin")
    one = matching.rule_reference(prev, new, PAYE, one_to_one=True)
    least = {}
    for (number, link), _ in expected.items():
        least[link] = min(number, least.get(link, number))
    assert Counter((r.UBRN, r.CH[0]) for r in one.collect()) == Counter((u, c) for c, u in least.items())
    # without links on a side there is nothing to compare
    assert matching.rule_reference(prev.limit(0), new, PAYE).count() == 0


def test_views_are_staged_by_small_tasks(spark, monkeypatch):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before, seen = spark.conf.get(size), []
    monkeypatch.setattr(adapters, "stage", lambda df, name: seen.append(spark.conf.get(size)) or df)
    tables = adapters.Tables(spark, "nowhere")
    assert tables._staged(spark.range(3), "paye").count() == 3
    assert seen == ["4m"] and spark.conf.get(size) == before


def _below(steps, node):
    """The plan's lines under the first line with the node's text."""
    lines = steps.splitlines()
    top = next(i for i, line in enumerate(lines) if node in line)
    depth = lines[top].index(node)
    rest = lines[top + 1:]
    end = next((i for i, line in enumerate(rest) if len(line) - len(line.lstrip(" :+-")) < depth), len(rest))
    return "\n".join(rest[:end])


def test_records_stay_out_of_the_shuffle_by_unit(spark):
    """Only places, sums, jobs and references go to the unit; it fetches its first records by key."""
    held = links(spark, (1, None, ["9", "2", "1"], ["x", "", "q"]), (2, None, ["2", "1"], ["q", "p"]),
                 (3, ["c"], None, None), (4, None, ["7"], ["x"]))
    vats = [{"vatref": 1, "name1": "one", "deathcode": "0"}, {"vatref": 2, "sic92": "9", "name1": "a"},
            {"vatref": 2, "sic92": "8", "name1": "b"}]
    payes = [{"payeref": "p", "name1": "p"}, {"payeref": "", "tradstyle1": "blank"},
             {"payeref": "q", "tradstyle1": "q2", "name1": "y"}, {"payeref": "q", "tradstyle1": "q1", "name1": "z"}]
    sources = [stage(df, "s") for df in (
        held, company(spark, {"CompanyNumber": "c"}), vat(spark, *vats), paye(spark, *payes), tcn(spark))]
    with small_cluster(spark):
        index = index_from(*sources)
        moved = _below(plan(index), "Exchange hashpartitioning(UBRN")
        got = {r.id: (r.BusinessName, r.TradingStyle, r.IndustryCode, r.VatRefs, r.PayeRefs) for r in index.collect()}
    assert "partial_min(vat" in moved
    assert "deathcode" not in moved and "tradstyle1" not in moved
    assert got == {
        1: ("B  ", "blank", "8", [2, 2, 1], ["", "q", "q"]),
        2: ("B  ", "q2", "8", [2, 2, 1], ["q", "q", "p"]),
        3: (None, None, None, [], []),
    }
