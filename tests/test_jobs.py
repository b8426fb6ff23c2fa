"""Files in, files out: every job in order on small sources."""

from __future__ import annotations

import json
from pathlib import Path

import pytest
from frames import B, bag, links
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from linkindex.operators import quality
from linkindex.plans import jobs
from linkindex.plans.layout import Layout
from linkindex.schemas import ADMIN_SCHEMAS, CH, INDEX, LEGAL_ENTITY_COLUMNS, LINKS, PAYE, TCN, VAT
from linkindex.sources import files, readers, staging, versions, writers

# A register made up for these tests: a mill with a company record, a shop with a PAYE scheme only,
# a ferry with a VAT record only, a farm with both, and an inn whose VAT name has one line.
LINK_ROWS = [
    {"CH": ["shop"], "VAT": [""], "PAYE": ["77/B"]},
    {"CH": ["00417733"], "VAT": ["500100"], "PAYE": [""]},
    {"CH": [""], "VAT": ["500200"], "PAYE": ["88/C"]},
    {"CH": ["ferry"], "VAT": ["500300"], "PAYE": [""]},
    {"CH": ["inn"], "VAT": ["500400"], "PAYE": ["99/D"]},
]
COMMON = {
    "entref": "9", "deathcode": "unlisted", "tradstyle1": "trading as", "status": "0",
    "address1": "4 Quay", "address2": "Old Dock", "address3": "Northport",
    "address4": "Westland", "address5": "Isles", "postcode": "NP9 4ZZ",
}
VATS = [
    ("500999", None, None, "nobody"), ("500200", None, None, "of the hill"),
    ("500300", None, "and sons", "ferries"), ("500400", "the grey", None, "inn"),
    ("500100", "old", "stone", "mill"),
]
PAYES = [
    ("77/B", "corner", "shop", "wages"), ("88/C", None, "hill", "farm"), ("99/D", "inn", None, "staff"),
]


def csv_line(src, values, quoted=False):
    """A line in file order; an empty cell is quoted or not, a quote inside a text is doubled."""
    cells = [values.get(n) or "" for n in ADMIN_SCHEMAS[src].names]
    if quoted:
        return ",".join('"' + c.replace('"', '""') + '"' for c in cells)
    return ",".join('"' + c.replace('"', '""') + '"' if set(c) & set(',"') else c for c in cells)


def write_csv(path, src, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    header = ",".join(f" Other.{n}" for n in ADMIN_SCHEMAS[src].names)
    path.write_text("\n".join([header, *lines]))


@pytest.fixture(scope="module")
def layout(spark, tmp_path_factory):
    home = tmp_path_factory.mktemp("home")
    out = Layout(str(home))
    ext = home / "external"
    write_csv(
        ext / "company" / "a.csv", CH,
        csv_line(
            CH,
            {
                "CompanyName": "? mill co", "CompanyNumber": "00417733", "CompanyStatus": "Active",
                "RegAddressAddressLine1": "THE MILL", "RegAddressAddressLine2": "RACE LANE",
                "RegAddressPostTown": "EASTBRIDGE", "RegAddressCounty": "SOUTHSHIRE",
                "RegAddressPostCode": "EB1 7QX", "SICCodeSicText_1": "10611 - Grain milling",
            },
            quoted=True,
        ),
    )
    write_csv(
        ext / "company" / "b.csv", CH,
        csv_line(CH, {"CompanyName": '"BIG", TOP & CO', "CompanyNumber": "00998877"}),
    )
    write_csv(
        ext / "vat" / "v.csv", VAT,
        *[
            csv_line(VAT, COMMON | {"vatref": r, "name1": a, "name2": b, "name3": c,
                                    "turnover": "0", "sic92": "sic92"})
            for r, a, b, c in VATS
        ],
    )
    write_csv(
        ext / "paye" / "p.csv", PAYE,
        *[
            csv_line(PAYE, COMMON | {"payeref": r, "name1": a, "name2": b, "name3": c, "stc": "0",
                                     "dec_jobs": "0", "mar_jobs": "0", "june_jobs": "0",
                                     "sept_jobs": "0", "jobs_lastupd": "jobs_lastupd"})
            for r, a, b, c in PAYES
        ],
    )
    write_csv(ext / "lookups" / "tcn-to-sic.csv", TCN, "0100,01500", "0501,06100", "0501,43130")
    (home / "links.json").write_text(json.dumps(LINK_ROWS))
    readers.read_links_json(spark, str(home / "links.json")).write.parquet(out.new_links)
    return out


def test_ingest(spark, layout):
    assert jobs.ingest(spark, layout) == {CH: 2, VAT: 5, PAYE: 3, TCN: 3}
    company = readers.read_parquet(spark, layout.working(CH))
    assert company.schema.simpleString() == ADMIN_SCHEMAS[CH].simpleString()
    assert bag(company.select("CompanyName", "CompanyNumber", "RegAddressCountry")) == [
        ('"BIG", TOP & CO', "00998877", None), ("? mill co", "00417733", None),
    ]
    vat = readers.read_parquet(spark, layout.working(VAT))
    assert [f.dataType.simpleString() for f in vat.schema if f.name in ("vatref", "status")] == [
        "bigint", "int",
    ]


def test_match_and_number(spark, layout):
    assert jobs.match_and_number(spark, layout, "201803011200", input_order=True) == 5
    work = readers.read_parquet(spark, layout.working(LINKS))
    assert bag(work) == [
        (B + i, r["CH"], r["VAT"], r["PAYE"]) for i, r in enumerate(LINK_ROWS, 1)
    ]
    for place in ("", "201803011200/"):
        copy = readers.read_prev_links(spark, f"{layout.prev_dir}/{place}{layout.files[LINKS]}")
        assert bag(copy) == bag(work)
    # next month with the same links, which reads and replaces the previous copy
    assert jobs.match_and_number(spark, layout, "201804011200") == 5
    again = readers.read_parquet(spark, layout.working(LINKS))
    assert bag(again) == bag(readers.read_prev_links(spark, layout.prev_links))
    assert sorted(r.UBRN for r in again.collect()) == [B + i for i in range(1, 6)]


def numbered_in_order(spark, layout):
    """The links under the numbers of their order in the input."""
    writers.write_parquet(
        links(spark, *[(B + i, r["CH"], r["VAT"], r["PAYE"]) for i, r in enumerate(LINK_ROWS, 1)]),
        layout.working(LINKS),
    )


ADDRESS = [COMMON[f"address{k}"] for k in range(1, 6)]
REST = ["trading as", "NP9 4ZZ"]


def unit(n, name, legal_status, vat_refs, paye_refs):
    """An index row of a unit without a company record."""
    return [B + n, name, REST[0], B + n, REST[1], *ADDRESS, None, "0", None, legal_status, None,
            None, vat_refs, paye_refs]


EXPECTED = [
    unit(1, "CORNER SHOP WAGES", None, [], ["77/B"]),
    [B + 2, "? MILL CO", REST[0], B + 2, "EB1 7QX", "THE MILL", "RACE LANE", "EASTBRIDGE",
     "SOUTHSHIRE", None, "10611", "1", "A", "A", None, "00417733", [500100], []],
    unit(3, "  OF THE HILL", "A", [500200], ["88/C"]),
    unit(4, " AND SONS FERRIES", "A", [500300], []),
    unit(5, "THE GREY  INN", "A", [500400], ["99/D"]),
]


def test_link_and_derive(spark, layout):
    numbered_in_order(spark, layout)
    assert jobs.link_and_derive(spark, layout) == 5
    index = readers.read_parquet(spark, layout.index)
    assert index.schema.simpleString() == INDEX.simpleString()
    assert [list(r) for r in index.orderBy("id").collect()] == EXPECTED


@pytest.mark.parametrize("single_file", [False, True])
def test_extract(spark, layout, single_file):
    assert jobs.extract(spark, layout, single_file) == {
        "legal-entities": 5, "legal-entities-refs": 5, "vat": 4, "paye": 3,
    }

    def read(name):
        path = layout.extract(name)
        if single_file:
            assert len(list(Path(path).glob("*.csv"))) == 1
        return spark.read.option("header", True).csv(path)

    refs = read("legal-entities-refs")
    assert refs.columns == [*LEGAL_ENTITY_COLUMNS, "VatRef", "PayeRef"]
    rows = refs.orderBy("id").collect()
    assert [(r.id, r.BusinessName, r.VatRef, r.PayeRef) for r in rows] == [
        (str(B + 1), "CORNER SHOP WAGES", "[]", "[77/B]"),
        (str(B + 2), "? MILL CO", "[500100]", "[]"),
        (str(B + 3), "OF THE HILL", "[500200]", "[88/C]"),
        (str(B + 4), "AND SONS FERRIES", "[500300]", "[]"),
        (str(B + 5), "THE GREY  INN", "[500400]", "[99/D]"),
    ]
    flat = read("legal-entities")
    assert flat.columns == LEGAL_ENTITY_COLUMNS
    assert [list(r) for r in flat.orderBy("id").collect()][1] == [
        str(B + 2), "? MILL CO", "trading as", "EB1 7QX", "THE MILL", "RACE LANE",
        "EASTBRIDGE", "SOUTHSHIRE", None, "10611", "1", "A", "A", None, "00417733",
    ]
    assert bag(read("vat")) == [
        (str(B + 2), "500100"), (str(B + 3), "500200"),
        (str(B + 4), "500300"), (str(B + 5), "500400"),
    ]
    assert bag(read("paye")) == [
        (str(B + 1), "77/B"), (str(B + 3), "88/C"), (str(B + 5), "99/D"),
    ]


def test_extract_from_links(spark, layout):
    numbered_in_order(spark, layout)
    jobs.link_and_derive(spark, layout)

    def read():
        return {
            name: bag(spark.read.option("header", True).csv(layout.extract(name)))
            for name in ("legal-entities", "vat", "paye")
        }

    rows = jobs.extract(spark, layout)
    by_index = read()
    fourth = Path(layout.extract("legal-entities-refs"))
    assert fourth.exists()
    del rows["legal-entities-refs"]
    assert jobs.extract_from_links(spark, layout) == rows
    assert read() == by_index and not fourth.exists()


def test_extract_is_quoted(spark, layout):
    jobs.extract(spark, layout, single_file=True)
    (part,) = Path(layout.extract("vat")).glob("*.csv")
    assert part.read_text().splitlines()[0] == '"id","VatRef"'
    assert f'"{B + 2}","500100"' in part.read_text().splitlines()


def test_publish(spark, layout):
    assert jobs.publish(spark, layout, "201803011200") == 5
    index = bag(readers.read_parquet(spark, layout.index))
    assert bag(readers.read_parquet(spark, layout.publish_dir)) == index
    assert bag(readers.read_parquet(spark, f"{layout.history_path}_201803011200")) == index
    lines = [
        line
        for part in Path(f"{layout.publish_dir}-bulk").glob("*.txt")
        for line in part.read_text().splitlines()
    ]
    actions = {json.loads(a)["index"]["_id"]: json.loads(d) for a, d in
               zip(lines[::2], lines[1::2], strict=True)}
    assert set(actions) == {str(B + i) for i in range(1, 6)}
    assert actions[str(B + 2)]["VatRefs"] == [500100]
    assert "EmploymentBands" not in actions[str(B + 2)]


def test_publish_needs_the_connector(spark, layout):
    with pytest.raises(Exception, match="DATA_SOURCE_NOT_FOUND"):
        jobs.publish(spark, layout, "201803011201", target="index/business")


def test_missing_previous_links_are_no_links(spark, tmp_path):
    frame = readers.read_prev_links(spark, str(tmp_path / "none"))
    assert frame.columns == ["UBRN", "CH", "VAT", "PAYE"]
    assert frame.isEmpty()


def test_broken_previous_links_are_an_error(spark, tmp_path):
    (tmp_path / "prev").mkdir()
    (tmp_path / "prev" / "part-0.parquet").write_text("this is not parquet")
    with pytest.raises(Exception) as e:
        readers.read_prev_links(spark, str(tmp_path / "prev")).collect()
    assert not (isinstance(e.value, AnalysisException)
                and e.value.getCondition() == "PATH_NOT_FOUND")


def test_a_failed_write_leaves_last_months_links(spark, tmp_path):
    work, prev = f"{tmp_path}/work", f"{tmp_path}/prev"

    def numbered(first, n):
        return spark.range(first, first + n, 1, 4).select(
            F.col("id").alias("UBRN"), *(F.array(F.lit(c)).alias(c) for c in ("CH", "VAT", "PAYE")))

    def kept():
        return sorted(r.UBRN for r in readers.read_prev_links(spark, f"{prev}/links").collect())

    broken = numbered(100, 40).withColumn(
        "UBRN", F.when(F.col("UBRN") % 10 == 7, F.raise_error(F.lit("half-way"))).otherwise(F.col("UBRN")))
    with pytest.raises(Exception, match="half-way"):  # a first month that fails leaves none
        writers.write_links(broken, work, prev, "links", "201801011200")
    assert kept() == []
    with pytest.raises(Exception, match="half-way"):
        writers.write_prev_links(broken, prev, "links")
    assert kept() == []
    writers.write_links(numbered(0, 20), work, prev, "links", "201802011200")
    for write in (lambda: writers.write_links(broken, work, prev, "links", "201803011200"),
                  lambda: writers.write_prev_links(broken, prev, "links"),
                  lambda: writers.write_prev_links(broken, prev, "links", "201802011200")):
        with pytest.raises(Exception, match="half-way"):
            write()
        assert kept() == list(range(20))
        dated = readers.read_parquet(spark, f"{prev}/201802011200/links")
        assert sorted(r.UBRN for r in dated.collect()) == list(range(20))
    same = readers.read_prev_links(spark, f"{prev}/links")  # read and replaced
    writers.write_links(same.unionAll(numbered(50, 2)), work, prev, "links", "201803011200")
    writers.write_prev_links(numbered(60, 3), prev, "links")
    assert kept() == [60, 61, 62]
    assert len(files.children(spark, f"{prev}/links.versions")) == 2


def test_lost_links_are_an_error(spark, tmp_path):
    links = spark.range(0, 6, 1, 2).select(F.col("id").alias("UBRN"))
    prev = f"{tmp_path}/prev"
    writers.write_prev_links(links, prev, "links", "201802011200")
    with pytest.raises(versions.LostTable, match="copies of 201802011200"):
        readers.read_prev_links(spark, f"{prev}/links")
    writers.write_prev_links(links, prev, "links")
    assert readers.read_prev_links(spark, f"{prev}/links").count() == 6
    folder = tmp_path / "prev" / "links.versions"
    version = next(folder.iterdir())
    part = next(p for p in version.iterdir() if p.suffix == ".parquet")
    part.rename(tmp_path / "part")
    with pytest.raises(versions.LostTable, match="of 6 rows"):
        readers.read_prev_links(spark, f"{prev}/links")
    version.rename(tmp_path / "version")
    with pytest.raises(versions.LostTable, match="cannot be read"):
        readers.read_prev_links(spark, f"{prev}/links")
    (tmp_path / "version").rename(version)
    files.write_text(spark, f"{prev}/links.current", '{"vers')
    with pytest.raises(versions.LostTable, match="names no version"):
        readers.read_prev_links(spark, f"{prev}/links")
    (tmp_path / "prev" / "links.current").rename(tmp_path / "current")
    with pytest.raises(versions.LostTable, match="is missing"):
        readers.read_prev_links(spark, f"{prev}/links")


def test_a_plain_folder_of_previous_links(spark, tmp_path):
    links = spark.range(5).select(F.col("id").alias("UBRN"))
    links.write.parquet(f"{tmp_path}/prev/links")
    assert readers.read_prev_links(spark, f"{tmp_path}/prev/links").count() == 5
    writers.write_links(links.limit(2), f"{tmp_path}/work", f"{tmp_path}/prev", "links", "201802011200")
    assert readers.read_prev_links(spark, f"{tmp_path}/prev/links").count() == 2


def test_bad_cells_are_null(spark, tmp_path):
    write_csv(tmp_path / "v.csv", VAT, csv_line(VAT, {"vatref": "x", "turnover": "1.5",
                                                     "name1": "n", "status": "7"}))
    row = readers.read_admin_csv(spark, str(tmp_path / "*.csv"), VAT).first()
    assert (row.vatref, row.turnover, row.name1, row.status) == (None, None, "n", 7)


def test_links_json_with_number(spark, tmp_path):
    (tmp_path / "l.json").write_text('{"UBRN": 5, "CH": ["a"]}\n{"VAT": ["v"]}\n')
    got = readers.read_links_json(spark, str(tmp_path / "l.json"), with_number=True)
    assert bag(got) == [(5, ["a"], None, None), (None, None, ["v"], None)]


def folder_of(df):
    return Path(df.inputFiles()[0].removeprefix("file:")).parent.parent


def test_staged_tables_go_when_done(spark):
    with staging.staged_until_done(spark):
        kept = staging.stage(spark.range(3), "t")
        assert kept.count() == 3
        folder = folder_of(kept)
        assert folder.exists()
    assert not folder.exists()


def test_runs_that_overlap_own_their_tables(spark):
    first, second = staging.staged_until_done(spark), staging.staged_until_done(spark)
    first.__enter__()
    one = staging.stage(spark.range(3), "one")
    second.__enter__()
    two = staging.stage(spark.range(4), "two")
    place = folder_of(one)
    staging.remove(spark, str(place))  # what the end of the first run does
    assert two.count() == 4
    second.__exit__(None, None, None)
    first.__exit__(None, None, None)
    assert not place.exists() and not folder_of_exists(two)


def folder_of_exists(df):
    return folder_of(df).exists()


def test_session_tables_can_be_cleared(spark):
    folder = folder_of(staging.stage(spark.range(2), "t"))
    assert folder.exists()
    staging.clear_session(spark)
    assert not folder.exists()


@pytest.mark.parametrize("folder", ["hdfs://place/checkpoints/", None])
def test_staging_folder_is_the_same_on_every_master(folder):
    class Session:
        class conf:
            settings = {"spark.checkpoint.dir": folder, "spark.sql.warehouse.dir": "s3://wh"}
            get = staticmethod(lambda name, default=None: Session.conf.settings[name] or default)

    assert staging.shared_dir(Session) == ("hdfs://place/checkpoints" if folder else "s3://wh")


def test_questions(spark):
    company = spark.createDataFrame(
        [["x", "CompanyNumber"], ["y", "1"], [None, None]],
        "CompanyName string, CompanyNumber string",
    )
    assert quality.header_leaks(company).first()[0] == 1
    assert bag(quality.profile(company)) == [
        ("CompanyName", "string", 3, 2), ("CompanyNumber", "string", 3, 2),
    ]
    payes = spark.createDataFrame([["1234", "n"], ["12345", "m"]], "payeref string, name1 string")
    assert bag(quality.refs_of_length(payes)) == [("1234", "n")]
    assert quality.refs_of_length(payes.union(payes), limit=1).count() == 1
    vats = spark.createDataFrame([[5], [6]], "vatref bigint")
    assert bag(quality.vat_by_ref(vats, 6, limit=1)) == [(6,)]
    some = links(spark, (1, None, ["5", "6"], None), (2, None, ["6"], None), (3, None, [], None))
    assert bag(quality.links_by_first_vat(some, 5).select("UBRN")) == [(1,)]
    readers.register_views(links=some)
    assert bag(spark.sql("SELECT UBRN FROM links WHERE get(VAT, 0) = '6'")) == [(2,)]
