"""The five raw feeds, derived from ``orders`` and ``lineitem``.

The statements are plain SQL, so that another engine can derive the same rows
(``oracle`` uses them too).  Every row of the source tables goes into the feeds built on its table; line items that
stand for no known exploitation, exploit or module give records and codes that name no advisory.  Second revisions are added
rows.  Exploit and module records list at most ``CHUNK`` codes each, so a record stays bounded
when one part or supplier holds a large share of the line items.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession, functions as F

from cveflow.schema import RAW, conform

AS_OF = "2001-08-02"
TIEBREAK = ["_batch_id"]
CHUNK = 100_000

_CVE = (
    "concat('CVE-', cast(2018 + {k} % 7 AS string), '-', "
    "lpad(cast({k} AS string), cast(greatest(7, length(cast({k} AS string))) AS int), '0'))"
)
_LINE_CVE = _CVE.replace("{k}", "l_orderkey")

NVD = """
WITH b AS (
  SELECT o_orderkey AS k, 0 AS rev, o_orderkey * 7919 % 101 AS s, o_orderstatus AS st,
         cast(o_orderdate AS date) AS d,
         cast(o_orderdate AS date) + cast(o_orderkey % 30 AS int) AS m FROM {orders}
  UNION ALL
  SELECT o_orderkey, 1, o_orderkey * 104729 % 101, o_orderstatus, cast(o_orderdate AS date),
         cast(o_orderdate AS date) + 40 FROM {orders} WHERE o_orderkey % 10 = 0),
c AS (
  SELECT *, CVE_OF_K AS cve,
         concat(cast(cast((s - s % 10) / 10 AS bigint) AS string), '.', cast(s % 10 AS string)) AS score,
         CASE WHEN s >= 90 THEN 'CRITICAL' WHEN s >= 70 THEN 'HIGH' WHEN s >= 40 THEN 'MEDIUM' ELSE 'LOW' END AS sev
  FROM b)
SELECT CASE WHEN k % 97 = 0 THEN concat('BAD-', cast(k AS string))
            WHEN k % 13 = 0 AND rev = 0 THEN concat(' ', lower(cve), ' ') ELSE cve END AS id,
       'cve@nist.gov' AS sourceIdentifier,
       concat(cast(d AS string), 'T00:00:00.000') AS published,
       concat(cast(m AS string), 'T00:00:00.000') AS lastModified,
       CASE WHEN k % 31 = 0 THEN 'Rejected' WHEN st = 'F' THEN 'Analyzed' WHEN st = 'O' THEN 'Modified'
            ELSE 'Awaiting Analysis' END AS vulnStatus,
       concat('[{"lang":"en","value":"Advisory ', cast(k AS string), '"}]') AS descriptions,
       CASE WHEN k % 17 = 0 THEN '{}' ELSE concat('{"cvssMetricV31":[{"cvssData":{"baseScore":', score,
            ',"baseSeverity":"', sev, '","vectorString":"CVSS:3.1/AV:N","attackVector":"NETWORK","attackComplexity":"',
            CASE WHEN k % 2 = 0 THEN 'LOW' ELSE 'HIGH' END, '"}}]}') END AS metrics,
       CASE WHEN k % 23 = 0 THEN '[]' WHEN k % 29 = 0 THEN '[{"description":[{"value":"NVD-CWE-noinfo"}]}]'
            ELSE concat('[{"description":[{"value":"CWE-', cast(k % 40 AS string), '"}]}]') END AS weaknesses,
       '[]' AS refs,
       CASE WHEN k % 5 = 0 THEN 'synthetic' ELSE 'nvd_api' END AS _source,
       CASE WHEN rev = 0 THEN timestamp '2001-08-01 00:00:00' ELSE timestamp '2001-08-02 00:00:00' END AS _ingested_at,
       cast(rev AS string) AS _batch_id
FROM c
""".replace("CVE_OF_K", _CVE.replace("{k}", "k"))

EPSS = """
SELECT CVE_OF_LINE AS cve,
       CASE WHEN l_partkey % 101 = 0 THEN 'n/a'
            ELSE cast(cast((l_partkey * 31 + l_linenumber * 7) % 121 - 10 AS double) / 100 AS string) END AS epss,
       cast(cast(l_suppkey * 13 % 101 AS double) / 100 AS string) AS percentile,
       cast(cast(l_shipdate AS date) AS string) AS date,
       CASE WHEN l_linenumber % 2 = 0 THEN timestamp '2001-08-01 00:00:00' ELSE timestamp '2001-08-02 00:00:00' END AS _ingested_at,
       concat(cast(l_linenumber AS string), '-', cast(l_partkey AS string), '-', cast(l_suppkey AS string)) AS _batch_id
FROM {lineitem}
""".replace("CVE_OF_LINE", _LINE_CVE)

KEV = """
WITH g AS (
  SELECT l_orderkey AS k, min(l_suppkey) AS sk, min(l_partkey) AS pk, cast(min(l_shipdate) AS date) AS d,
         max(CASE WHEN l_returnflag = 'R' AND l_discount >= 0.08 THEN 1 ELSE 0 END) AS known
  FROM {lineitem} GROUP BY l_orderkey),
r AS (SELECT *, 0 AS rev FROM g UNION ALL SELECT *, 1 FROM g WHERE k % 10 = 0)
SELECT CASE WHEN known = 1 THEN CVE_OF_K ELSE concat('OTHER-', cast(k AS string)) END AS cveID,
       CASE WHEN sk % 19 = 0 THEN '' ELSE concat(' Vendor ', cast(sk % 40 AS string), ' ') END AS vendorProject,
       concat('Product ', cast(pk % 60 AS string)) AS product,
       concat('Issue ', cast(k AS string)) AS vulnerabilityName,
       CASE WHEN k % 43 = 0 THEN 'unknown' ELSE cast(d AS string) END AS dateAdded,
       'Apply updates' AS requiredAction,
       cast(d + 21 AS string) AS dueDate,
       concat(' Summary ', cast(k % 50 AS string)) AS shortDescription,
       concat('Note ', cast(k % 7 AS string)) AS notes,
       '2001.08.02' AS catalogVersion,
       concat(cast(d + 30 AS string), 'T00:00:00.000Z') AS dateReleased,
       CASE WHEN rev = 1 THEN 'KNOWN' WHEN k % 3 = 0 THEN 'Known' ELSE 'Unknown' END AS knownRansomwareCampaignUse,
       CASE WHEN rev = 0 THEN timestamp '2001-08-01 00:00:00' ELSE timestamp '2001-08-02 00:00:00' END AS _ingested_at,
       cast(rev AS string) AS _batch_id
FROM r
""".replace("CVE_OF_K", _CVE.replace("{k}", "k"))

EXPLOITS = """
WITH u AS (
  SELECT l_partkey AS pk, cast(floor(l_orderkey / CHUNK) AS bigint) AS ch, cast(min(l_shipdate) AS date) AS sd,
         CASE WHEN max(l_quantity) >= 45 THEN CVE_OF_LINE ELSE concat('EDB-', cast(l_orderkey AS string)) END AS cve
  FROM {lineitem} GROUP BY l_partkey, l_orderkey),
g AS (SELECT pk, ch, min(sd) AS d, listagg(cve, ';') WITHIN GROUP (ORDER BY cve) AS cves FROM u GROUP BY pk, ch)
SELECT CASE WHEN pk % 211 = 0 THEN '' ELSE concat(cast(pk AS string), '-', cast(ch AS string)) END AS id,
       concat('exploits/', cast(pk AS string), '.py') AS file,
       concat('Exploit ', cast(pk AS string)) AS description,
       CASE WHEN pk % 47 = 0 THEN '' ELSE cast(d AS string) END AS date_published,
       concat('researcher_', cast(pk % 50 AS string)) AS author,
       CASE WHEN pk % 4 = 0 THEN ' Windows' WHEN pk % 4 = 1 THEN 'linux ' WHEN pk % 4 = 2 THEN 'Multiple' ELSE 'unix' END AS platform,
       CASE WHEN pk % 3 = 0 THEN 'Remote' WHEN pk % 3 = 1 THEN 'local' ELSE ' webapps' END AS type,
       CASE WHEN pk % 5 = 0 THEN '' ELSE cast(pk % 9000 AS string) END AS port,
       CASE WHEN pk % 37 = 0 THEN '' ELSE concat('OSVDB-', cast(pk AS string), ';', cves) END AS codes,
       timestamp '2001-08-01 00:00:00' AS _ingested_at,
       '0' AS _batch_id
FROM g
""".replace("CVE_OF_LINE", _LINE_CVE).replace("CHUNK", str(CHUNK))

MODULES = """
WITH u AS (
  SELECT l_suppkey AS sk, cast(floor(l_orderkey / CHUNK) AS bigint) AS ch, cast(min(l_shipdate) AS date) AS sd,
         CASE WHEN max(CASE WHEN l_tax >= 0.08 THEN l_quantity ELSE 0 END) >= 48 THEN CVE_OF_LINE
              ELSE concat('URL-', cast(l_orderkey AS string)) END AS cve
  FROM {lineitem} GROUP BY l_suppkey, l_orderkey),
g AS (SELECT sk, ch, min(sd) AS d, listagg(cve, '","') WITHIN GROUP (ORDER BY cve) AS cves FROM u GROUP BY sk, ch)
SELECT concat('exploit/multi/mod_', cast(sk AS string), '_', cast(ch AS string)) AS fullname,
       concat('mod_', cast(sk AS string)) AS name,
       concat('Module ', cast(sk AS string)) AS title,
       CASE WHEN sk % 9 = 0 THEN 'excellent' WHEN sk % 9 = 1 THEN 'Great' WHEN sk % 9 = 2 THEN 'good'
            WHEN sk % 9 = 3 THEN 'normal' WHEN sk % 9 = 4 THEN 'average' WHEN sk % 9 = 5 THEN 'LOW'
            WHEN sk % 9 = 6 THEN 'manual' WHEN sk % 9 = 7 THEN '600' ELSE 'unranked' END AS rank,
       cast(d AS string) AS disclosure_date,
       CASE WHEN sk % 2 = 0 THEN ' Exploit' ELSE 'auxiliary' END AS type,
       '["linux","windows"]' AS platform,
       concat(cast(d AS string), ' 10:00:00 +0000') AS mod_time,
       concat('["researcher_', cast(sk % 20 AS string), '"]') AS author,
       concat('["', cves, '","EDB-', cast(sk AS string), '"]') AS refs,
       timestamp '2001-08-01 00:00:00' AS _ingested_at,
       '0' AS _batch_id
FROM g
""".replace("CVE_OF_LINE", _LINE_CVE).replace("CHUNK", str(CHUNK))

STATEMENTS = {"nvd": NVD, "kev": KEV, "epss": EPSS, "exploits": EXPLOITS, "modules": MODULES}


def _view(spark: SparkSession, sf_dir: str, table: str) -> str:
    name = f"cveflow_{table}_{zlib.crc32(sf_dir.encode()):08x}"
    if not spark.catalog.tableExists(name):
        spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet").createOrReplaceTempView(name)
    return name


def raw(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    """One raw feed with its full declared schema; columns the statement lacks are ``''``."""
    text = STATEMENTS[feed]
    for table in ("orders", "lineitem"):
        if f"{{{table}}}" in text:
            text = text.replace(f"{{{table}}}", _view(spark, sf_dir, table))
    df = spark.sql(text).withColumns({
        "year": F.year("_ingested_at"), "month": F.month("_ingested_at"), "day": F.day("_ingested_at"),
    })
    if "refs" in df.columns:
        df = df.withColumnRenamed("refs", "references")
    missing = [f.name for f in RAW[feed].fields if f.name not in df.columns]
    return conform(df.withColumns({c: F.lit("") for c in missing}) if missing else df, RAW[feed])
