"""Feed readers on small files, and the ingestion steps."""

import datetime as dt
import gzip
import json

from pyspark.sql import functions as F

from cveflow import clean, feeds, planning, schema


def test_nvd_pages(spark, tmp_path):
    cve = {"id": "CVE-2024-0001", "published": "2024-01-01T00:00:00.000", "vulnStatus": None, "extra": {"a": 1},
           "metrics": {"cvssMetricV31": [{"cvssData": {"baseScore": 9.8, "baseSeverity": "CRITICAL"}}]},
           "descriptions": [{"lang": "en", "value": "quote \" and é"}]}
    (tmp_path / "p1.json").write_text(json.dumps({"totalResults": 2, "vulnerabilities": [{"cve": cve}]}, indent=1))
    (tmp_path / "p2.json").write_text(json.dumps({"vulnerabilities": [{"cve": {"id": "CVE-2024-0002"}}]}))
    (tmp_path / "p3.json").write_text(json.dumps({"vulnerabilities": []}))
    df = feeds.read_nvd(spark, str(tmp_path))
    assert df.columns == list(schema.NVD_FIELDS)
    out = {r.id: r for r in df.collect()}
    assert json.loads(out["CVE-2024-0001"].metrics) == cve["metrics"]
    assert (out["CVE-2024-0001"].vulnStatus, out["CVE-2024-0001"].cveTags) == (None, "[]")
    assert (out["CVE-2024-0002"].metrics, out["CVE-2024-0002"].references) == ("{}", "[]")
    stamped = feeds.stamp(df, now="2024-02-03 04:05:06", source="nvd_api", batch_id="x")
    first = clean.nvd(stamped).where("cve_id = 'CVE-2024-0001'").first()
    assert (first.cvss_v31_base_score, first.description_en) == (9.8, 'quote " and é')
    assert (first.year, first.month, first.day) == (2024, 2, 3)


def test_kev_catalogue(spark, tmp_path):
    doc = {"title": "t", "catalogVersion": "v1", "dateReleased": "2024-01-01T00:00:00Z", "count": 2, "vulnerabilities": [
        {"cveID": "CVE-2024-0001", "vendorProject": "A", "cwes": ["CWE-1"]}, {"cveID": "CVE-2024-0002", "notes": "n"}]}
    (tmp_path / "kev.json").write_text(json.dumps(doc, indent=2))
    df = feeds.read_kev(spark, str(tmp_path / "kev.json"))
    assert df.columns == list(schema.KEV_FIELDS)
    rows = sorted(df.collect(), key=lambda r: r.cveID)
    assert [(r.cveID, r.catalogVersion, r["count"]) for r in rows] == [("CVE-2024-0001", "v1", "2"), ("CVE-2024-0002", "v1", "2")]
    assert (rows[0].vendorProject, rows[0].notes, rows[1].notes) == ("A", None, "n")


def test_epss_files_each_carry_their_date(spark, tmp_path):
    def put(name, comment, rows):
        with gzip.open(tmp_path / name, "wt") as f:
            f.write(comment + "cve,epss,percentile\n" + "".join(r + "\n" for r in rows))

    put("a.csv.gz", "#model_version:v2023.03.01,score_date:2024-01-05T00:00:00+0000\n", ["CVE-2024-0001,0.1,0.2", "CVE-2024-0002,,"])
    put("b.csv.gz", "#model_version:v2023.03.01,score_date:2024-01-06T00:00:00+0000\n", ["CVE-2024-0001,0.3,0.4"])
    put("c.csv.gz", "", ["CVE-2024-0003,0.5,0.6"])
    rows = sorted(tuple(r) for r in feeds.read_epss(spark, str(tmp_path), as_of="2024-02-01").fillna("").collect())
    assert rows == [
        ("CVE-2024-0001", "0.1", "0.2", "2024-01-05"), ("CVE-2024-0001", "0.3", "0.4", "2024-01-06"),
        ("CVE-2024-0002", "", "", "2024-01-05"), ("CVE-2024-0003", "0.5", "0.6", "2024-02-01"),
    ]


def test_exploit_csv_by_name_with_quoted_newline(spark, tmp_path):
    (tmp_path / "x.csv").write_text(
        "id,file,description,date_published,author,type,platform,port,date_added,codes,tags\n"
        '1,f.py,"two\nlines, ""quoted""",2024-01-01,me,remote,linux,80,2024-01-02,CVE-2024-0001;OSVDB-1,x\n'
        "2,g.py,plain,2024-01-01,me,local,,,2024-01-02,,\n"
    )
    rows = {r.id: r for r in feeds.read_exploits(spark, str(tmp_path / "x.csv"), multiline=True).collect()}
    assert rows["1"].description == 'two\nlines, "quoted"'
    assert (rows["1"].type, rows["1"].platform, rows["1"].codes) == ("remote", "linux", "CVE-2024-0001;OSVDB-1")
    assert (rows["2"].platform, rows["2"].port, rows["2"].codes) == ("", "", "")


def test_module_map(spark, tmp_path):
    doc = {
        "exploit/a": {"name": "A", "fullname": "x", "aliases": ["b"], "rank": 600, "rport": None, "check": True,
                      "post_auth": False, "notes": {"Stability": ["crash-safe"]}, "references": ["CVE-2024-0001"],
                      "targets": None, "path": None, "description": "d"},
        "exploit/b": {},
    }
    (tmp_path / "m.json").write_text(json.dumps(doc, indent=2))
    df = feeds.read_modules(spark, str(tmp_path / "m.json"))
    assert df.columns == list(schema.MODULE_FIELDS)
    a, b = sorted(df.collect(), key=lambda r: r.fullname)
    assert (a.fullname, a.name, a.rank, a.rport, a.check, a.post_auth) == ("exploit/a", "A", "600", "None", "True", "False")
    assert (json.loads(a.notes), json.loads(a.references), a.targets, a.path) == ({"Stability": ["crash-safe"]}, ["CVE-2024-0001"], "null", None)
    assert (b.name, b.aliases, b.notes, b.rport, b.check) == ("", "[]", "{}", "", "")


def test_empty_feed_has_the_declared_schema(spark, tmp_path):
    for feed, declared in schema.RAW.items():
        empty = feeds.or_empty(spark, None, declared)
        assert empty.schema == declared and empty.isEmpty()
        cleaned = getattr(clean, feed)(empty)
        assert cleaned.columns == schema.CLEAN[feed].names and cleaned.isEmpty()
    kept = feeds.or_empty(spark, spark.createDataFrame([("CVE-1", 1)], "cve string, extra int"), schema.RAW["epss"])
    assert kept.columns == schema.RAW["epss"].names and kept.first().cve == "CVE-1"


def test_clean_tables_have_the_declared_types(spark, tables):
    for feed in schema.CLEAN:
        have = {f.name: f.dataType.simpleString() for f in getattr(tables, feed)().schema.fields}
        assert have == {f.name: f.dataType.simpleString() for f in schema.CLEAN[feed].fields}


def test_dated_epss_folders_are_read_once(spark, tmp_path):
    for day in ("2024-01-05", "2024-01-06"):
        (tmp_path / f"date={day}").mkdir()
        (tmp_path / f"date={day}" / "a.csv").write_text(f"#score_date:{day}\ncve,epss,percentile\nCVE-2024-0001,0.1,0.2\n")
    df = feeds.read_epss(spark, str(tmp_path), dated=True)
    assert sorted(map(tuple, df.collect())) == [("CVE-2024-0001", "0.1", "0.2", "2024-01-05"), ("CVE-2024-0001", "0.1", "0.2", "2024-01-06")]
    text = df._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and "Join" not in text


def test_release_date_of_a_catalogue(spark):
    raw = spark.createDataFrame([("CVE-2024-0001", "2001-08-02T00:00:00.000Z"), ("CVE-2024-0002", "soon")], "cveID string, dateReleased string")
    rows = clean.kev_rows(schema.conform(raw, schema.RAW["kev"])).collect()
    assert {r.cve_id: str(r.date_released) for r in rows} == {"CVE-2024-0001": "2001-08-02", "CVE-2024-0002": "None"}


def test_top_up_by_name(spark):
    df, extra = spark.range(10).withColumn("x", F.lit("a")), spark.range(3)
    more = feeds.top_up(df, extra)
    assert more.count() == 13 and more.where("x is null").count() == 3


def test_windows_cover_the_span_without_gaps(spark):
    rows = planning.plan_windows(spark, "2000-01-01", "2001-01-01 12:00:00").orderBy("window_start").collect()
    assert rows[0][0] == dt.datetime(2000, 1, 1) and rows[-1][1] == dt.datetime(2001, 1, 1, 12)
    assert all(a[1] == b[0] for a, b in zip(rows, rows[1:]))
    assert all(r[1] - r[0] <= dt.timedelta(days=119) for r in rows) and len(rows) == 4
    exact = planning.plan_windows(spark, "2000-01-01", "2000-08-26").count()  # 238 days
    assert exact == 2
    assert planning.plan_windows(spark, "2000-01-01", "2000-01-01").isEmpty()
    assert planning.plan_windows(spark, "2000-01-02", "2000-01-01").isEmpty()


def test_offsets(spark):
    windows = spark.createDataFrame([(1, 0), (2, 1), (3, 2000), (4, 2001), (5, 6000)], "w int, total long")
    pages = planning.plan_offsets(windows).groupBy("w").agg(F.sort_array(F.collect_list("offset")).alias("o"))
    assert {r.w: r.o for r in pages.collect()} == {2: [0], 3: [0], 4: [0, 2000], 5: [0, 2000, 4000]}


def test_every_modified_row_is_in_a_planned_window(spark, tables):
    raw = tables.raw("nvd")
    totals = planning.count_by_window(raw, "1990-01-01", "2005-01-01")
    windows = planning.plan_windows(spark, "1990-01-01", "2005-01-01")
    assert totals.join(windows, "window_start").agg(F.sum("total")).first()[0] == raw.count()


def test_high_water_mark(spark):
    raw = spark.createDataFrame(
        [("2024-01-01", "nvd_api"), ("2027-01-01", "synthetic"), (None, "nvd_api"), ("2023-01-01", None)],
        "lastModified string, _source string")
    assert planning.high_water_mark(raw).first()[0] == "2024-01-01"
    assert planning.high_water_mark(raw.where("false")).first()[0] == "1999-01-01"
    assert planning.high_water_mark(raw, exclude_sources=()).first()[0] == "2027-01-01"
