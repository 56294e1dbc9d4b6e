"""Cleaners on hand-made edge rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cveflow import clean, ids, schema, testfeeds, values

STAMP = {"_ingested_at": dt.datetime(2024, 5, 1), "_source": "s", "_batch_id": "b", "year": 2024, "month": 5, "day": 1}


def raw(spark, feed, rows):
    names = schema.RAW[feed].names
    return spark.createDataFrame([tuple({**STAMP, **r}.get(n) for n in names) for r in rows], schema.RAW[feed])


def metrics(score, severity="HIGH"):
    return (
        '{"cvssMetricV40": [{"x": {"y": [1, 2]}}], "cvssMetricV31": [{"source": "a", "cvssData": {"baseScore": %s, '
        '"baseSeverity": "%s", "vectorString": "V", "attackVector": "NETWORK", "attackComplexity": "LOW"}}, '
        '{"cvssData": {"baseScore": 1.0}}]}' % (score, severity)
    )


@pytest.mark.parametrize("text,valid", [
    ("CVE-2024-1234", True), (" cve-2024-12345 ", True), ("CVE-2024-123", False),
    ("CVE-24-1234", False), ("XCVE-2024-1234", False), ("", False), (None, False),
])
def test_ids(spark, text, valid):
    df = spark.createDataFrame([(text,)], "id string").select(ids.normalise("id").alias("id"))
    assert df.where(ids.is_valid("id")).count() == int(valid)


def test_list_ids_are_taken_as_they_stand(spark):
    df = spark.createDataFrame([("CVE-2024-1; CVE-2024-2;cve-2024-3;CVE-2024-4;OSVDB-1",), ("",), (None,)], "c string")
    rows = [r[0] for r in df.select(ids.extract_list("c")).collect()]
    assert rows == [["CVE-2024-1", "CVE-2024-4"], [], None]


def test_nvd(spark):
    rows = [
        {"id": " cve-2024-0001 ", "published": "2024-01-02T03:04:05.678", "lastModified": "2024-01-03T00:00:00",
         "descriptions": '[{"lang":"es","value":"uno"},{"lang":"en","value":"one"}]', "metrics": metrics(9.8),
         "weaknesses": '[{"description":[{"value":"CWE-79"},{"value":"CWE-80"}]}]'},
        {"id": "CVE-2024-0001", "published": "bad", "lastModified": "2024-01-02T00:00:00", "metrics": metrics(1.1)},
        {"id": "CVE-2024-0002", "published": "not a date", "lastModified": None, "metrics": "{torn", "weaknesses": "[]",
         "descriptions": "[]"},
        {"id": "CVE-2024-0003", "metrics": metrics('"n/a"'), "lastModified": "2024-01-01T00:00:00"},
        {"id": "CVE-2024-0004", "metrics": '{"cvssMetricV31": []}'},
        {"id": "bad"}, {"id": None},
    ]
    out = {r.cve_id: r for r in clean.nvd(raw(spark, "nvd", rows)).collect()}
    assert sorted(out) == ["CVE-2024-0001", "CVE-2024-0002", "CVE-2024-0003", "CVE-2024-0004"]
    one = out["CVE-2024-0001"]
    assert (one.description_en, one.cvss_v31_base_score, one.cvss_v31_severity) == ("uno", 9.8, "HIGH")
    assert (one.cvss_v31_vector, one.cvss_v31_attack_vector, one.cvss_v31_attack_complexity) == ("V", "NETWORK", "LOW")
    assert (one.primary_cwe, one.published_ts) == ("CWE-79", dt.datetime(2024, 1, 2, 3, 4, 5, 678000))
    two = out["CVE-2024-0002"]
    assert (two.published_ts, two.cvss_v31_base_score, two.cvss_v31_severity, two.primary_cwe) == (None, 0.0, "UNKNOWN", None)
    assert out["CVE-2024-0003"].cvss_v31_base_score == 0.0 and out["CVE-2024-0003"].cvss_v31_severity == "HIGH"
    assert out["CVE-2024-0004"].cvss_v31_severity == "UNKNOWN"


def test_kev(spark):
    rows = [
        {"cveID": "cve-2024-0001", "vendorProject": " V ", "dateAdded": "2024-02-30", "dueDate": "2024-03-01",
         "knownRansomwareCampaignUse": "KNOWN", "dateReleased": "2024-03-01"},
        {"cveID": "CVE-2024-0002", "knownRansomwareCampaignUse": " Known"},
        {"cveID": "CVE-2024-0003", "knownRansomwareCampaignUse": None, "dateAdded": "2024-03-01T00:00:00Z"},
    ]
    out = {r.cve_id: r for r in clean.kev(raw(spark, "kev", rows)).collect()}
    assert (out["CVE-2024-0001"].vendor_project, out["CVE-2024-0001"].date_added) == ("V", None)
    assert out["CVE-2024-0001"].due_date == dt.date(2024, 3, 1)
    assert [out[f"CVE-2024-000{i}"].is_ransomware_related for i in (1, 2, 3)] == [True, False, False]
    assert out["CVE-2024-0003"].date_added is None


def test_epss(spark):
    rows = [{"cve": f"CVE-2024-000{i}", "epss": e, "percentile": p, "date": "2024-01-01"} for i, (e, p) in enumerate(
        [("0.5", "0.1"), ("1.7", "-3"), ("-0.2", None), ("NaN", "x"), ("n/a", "0.5"), (None, "0.5")])]
    out = {r.cve_id[-1]: (r.epss_score, r.epss_percentile) for r in clean.epss(raw(spark, "epss", rows)).collect()}
    assert out == {"0": (0.5, 0.1), "1": (1.0, 0.0), "2": (0.0, None), "3": (1.0, None)}


def test_exploits(spark):
    rows = [
        {"id": " 7 ", "date_published": "2024-13-01", "platform": " Windows", "type": "Remote ", "port": "",
         "codes": "CVE-2024-0001;CVE-2024-0001;EDB-1"},
        {"id": "8", "date_published": "2024-01-01", "port": "443", "codes": None},
        {"id": "  "}, {"id": ""}, {"id": None},
    ]
    out = {r.exploit_id: r for r in clean.exploits(raw(spark, "exploits", rows)).collect()}
    assert sorted(out) == ["7", "8"]
    seven, eight = out["7"], out["8"]
    assert (seven.date_published_dt, seven.platform_clean, seven.exploit_type, seven.port_num) == (None, "windows", "remote", None)
    assert (seven.cve_ids, seven.cve_count) == (["CVE-2024-0001"] * 2, 2)
    assert (eight.port_num, eight.cve_ids, eight.cve_count) == (443, None, None)


@pytest.mark.parametrize("label,number", [
    ("excellent", 7), ("Great", 6), ("GOOD", 5), ("normal", 4), ("average", 3), ("low", 2), ("manual", 1),
    ("600", 600), ("unranked", None), (" Great ", None), ("", None), (None, None),
])
def test_rank_number(spark, label, number):
    df = spark.createDataFrame([(label,)], "rank string")
    assert df.select(values.rank_number(F.col("rank"))).first()[0] == number


def test_modules(spark):
    rows = [
        {"fullname": "a", "references": '["CVE-2024-0001", "URL-x", "cve-2024-2"]', "platform": '["linux"]',
         "author": '{"x": 1}', "mod_time": "2024-01-02 03:04:05 +0000", "disclosure_date": "2024-1-2", "rank": "Good"},
        {"fullname": "b", "references": "[torn", "mod_time": "soon"},
        {"fullname": ""},
    ]
    out = {r.fullname: r for r in clean.modules(raw(spark, "modules", rows)).collect()}
    a, b = out["a"], out["b"]
    assert sorted(out) == ["a", "b"]
    assert (a.cve_ids, a.cve_count, a.platforms, a.authors) == (["CVE-2024-0001"], 1, ["linux"], None)
    assert a.mod_time_ts == dt.datetime(2024, 1, 2, 3, 4, 5) and a.rank_numeric == 5
    assert (b.cve_ids, b.cve_count, b.mod_time_ts) == (None, None, None)


@pytest.mark.parametrize("feed", ["nvd", "kev", "epss", "exploits", "modules"])
def test_cleaning_is_idempotent_under_reingestion(spark, sf_dir, feed):
    rows = testfeeds.raw(spark, sf_dir, feed)
    clean_feed = getattr(clean, feed)
    once = clean_feed(rows, tiebreak=testfeeds.TIEBREAK)
    twice = clean_feed(rows.unionByName(rows), tiebreak=testfeeds.TIEBREAK)
    assert once.schema == schema.CLEAN[feed] or once.columns == schema.CLEAN[feed].names
    assert once.exceptAll(twice).isEmpty() and twice.exceptAll(once).isEmpty()
