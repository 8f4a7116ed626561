"""Binding of the given tables to the event schema.

The given data holds no process log, so ``process_events`` derives one, row by
row, from ``events`` joined to ``pages`` (URLs) and ``documents`` (whole
texts).  Every event row gives exactly one process event.  The first events take
a document each and the next ones a page each, so that all of them are read as
long as there are as many events.  The lists below are parameters of that derivation; ``plans.oracle`` renders the same derivation as
SQL for the checks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

IMAGES = [
    "C:\\Windows\\System32\\certutil.exe",
    "C:\\Windows\\System32\\cmd.exe",
    "C:\\Windows\\System32\\WindowsPowerShell\\v1.0\\powershell.exe",
    "C:\\Windows\\System32\\mshta.exe",
    "C:\\Windows\\System32\\regsvr32.exe",
    "C:\\Windows\\System32\\rundll32.exe",
    "C:\\Windows\\System32\\bitsadmin.exe",
    "C:\\Windows\\Microsoft.NET\\Framework64\\v4.0.30319\\MSBuild.exe",
    "C:\\Windows\\System32\\wscript.exe",
    "C:\\Windows\\System32\\cscript.exe",
    "C:\\Windows\\Microsoft.NET\\Framework\\v4.0.30319\\InstallUtil.exe",
    "C:\\Program Files\\Google\\Chrome\\Application\\chrome.exe",
    "C:\\Windows\\System32\\notepad.exe",
    "C:/Windows/System32/schtasks.exe",
    "C:\\Windows\\System32\\wbem\\WMIC.exe",
    "C:\\Windows\\System32\\svchost.exe",
    "C:\\Tools\\",
]
PARENTS = [
    "C:\\Windows\\explorer.exe",
    "C:\\Windows\\System32\\services.exe",
    "C:\\Windows\\System32\\svchost.exe",
    "C:\\Program Files\\Microsoft Office\\root\\Office16\\WINWORD.EXE",
    "C:\\Program Files\\Microsoft Office\\root\\Office16\\EXCEL.EXE",
    "C:\\Program Files\\Microsoft Office\\root\\Office16\\OUTLOOK.EXE",
    "C:\\Program Files\\Microsoft Office\\root\\Office16\\POWERPNT.EXE",
    "C:\\Program Files\\Google\\Chrome\\Application\\chrome.exe",
    "C:/Program Files (x86)/Microsoft/Edge/Application/msedge.exe",
    "C:\\Windows\\System32\\cmd.exe",
    "C:\\Windows\\System32\\WindowsPowerShell\\v1.0\\powershell.exe",
    "C:\\Windows\\System32\\userinit.exe",
    "C:\\Windows\\explorer.exe",
]
# (text before, payload, text after); payload: None, url, props, props64, doc, doc64
TEMPLATES = [
    (" -urlcache -split -f ", "url", " out.exe"),
    (" -urlcache -verify ", "url", ""),
    (" -decode C:\\Temp\\in.txt out.bin", None, ""),
    (" /transfer job1 /download ", "url", " C:\\Temp\\a.exe"),
    (" javascript:\"\\..\\mshtml,RunHTMLApplication\"", None, ""),
    (" vbscript:Execute(\"CreateObject(1)\")", None, ""),
    (" /s /n /u /i:", "url", " scrobj.dll"),
    (" -nop -w hidden -enc ", "props64", ""),
    (" -NoProfile -Command \"Write-Output ", "doc", "\""),
    (" -EncodedCommand ", "doc64", ""),
    (" C:\\Users\\Public\\build.csproj", None, ""),
    (" C:\\Projects\\app\\app.sln /p:Configuration=Release", None, ""),
    (" //e:jscript  C:\\Scripts\\x.js", None, ""),
    (" ", "url", ""),
    ("", None, ""),
    (" --no-first-run --profile ", "props", ""),
    (" /c ping 192.168.10.25\t-n 4", None, ""),
    (" -k netsvcs -p -s Schedule /v 10.0.19041.1", None, ""),
    (" IEX(New-Object Net.WebClient).DownloadString('", "url", "')"),
    (" process list full", None, ""),
    (" -ec ", "props64", ""),
    (" curl -o x.bin ", "url", ""),
    (" shell32.dll,Control_RunDLL appwiz.cpl ", "props", ""),
]
DOC_TEMPLATES = [i for i, t in enumerate(TEMPLATES) if t[1] in ("doc", "doc64")]
URL_TEMPLATES = [i for i, t in enumerate(TEMPLATES) if t[1] == "url"]
INTEGRITY = ["Low", "Medium", "High", "System", "Protected"]
TECHNIQUES = [
    ("T1105", "Ingress Tool Transfer"),
    ("T1218.005", "Mshta"),
    ("T1218.010", "Regsvr32"),
    ("T1218.011", "Rundll32"),
    ("T1059.001", "PowerShell"),
    ("T1204.002", "Malicious File"),
    ("T1197", "BITS Jobs"),
    ("T1127.001", "MSBuild"),
    ("T1059.005", "Visual Basic"),
    ("T1140", "Deobfuscate/Decode Files"),
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A tiny input in fewer files than cores is spread over the cores.

    Large inputs already have more splits than cores and are left as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = df.rdd.getNumPartitions()
    return df.repartition(cores) if splits < cores else df


def plain_base64(column: str) -> Column:
    """Base64 text without line breaks, which are taken out where there are any, not character by character."""
    return F.replace(F.base64(F.encode(F.col(column), "UTF-8")), F.lit("\r\n"), F.lit(""))


def pick(values: list, index: Column) -> Column:
    """The list element at a zero-based index."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def process_events(spark: SparkSession, sf_dir: str, every_document: bool = False) -> DataFrame:
    """One process event per row of ``events``.

    Event n takes document n, and event ``documents + n`` page n, whatever their templates
    would be; later events have no document, and pages in turn.  With ``every_document``
    later events whose template asks for a document take one in turn, too.
    """
    e = spread(read_table(spark, sf_dir, "events").drop("value"))
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    n_pages, n_docs = pages.count(), docs.count()  # answered from file footers

    eid, uid = F.col("event_id"), F.col("user_id")
    with_doc, bound = eid < n_docs, eid < n_docs + n_pages
    t_idx = (F.when(with_doc, pick(DOC_TEMPLATES, eid % len(DOC_TEMPLATES)))
             .when(bound, pick(URL_TEMPLATES, eid % len(URL_TEMPLATES)))
             .otherwise((eid * 3 + uid) % len(TEMPLATES)))
    payload_of = pick([t[1] or "" for t in TEMPLATES], t_idx)
    keyed = e.withColumn("payload_kind", payload_of if every_document else F.when(with_doc, payload_of).otherwise(
        F.replace(payload_of, F.lit("doc"), F.lit("props"))))
    # The join keys are spread evenly over the events, so no key is hot; rows
    # whose template holds no such payload match nothing.
    joined = (
        keyed
        .join(pages, (F.col("page_id") == eid % n_pages)
              & (F.col("payload_kind") == "url"), "left")
        .join(docs, (F.col("doc_id") == eid % n_docs)
              & F.col("payload_kind").isin("doc", "doc64"), "left")
    )
    kind = F.col("payload_kind")
    payload = (
        F.when(kind == "url", F.col("url"))
        .when(kind == "props", F.col("props"))
        .when(kind == "props64", plain_base64("props"))
        .when(kind == "doc", F.col("text"))
        .when(kind == "doc64", plain_base64("text"))
        .otherwise("")
    )
    image = pick(IMAGES, (eid * 7 + uid) % len(IMAGES))
    parent = F.when(eid % 101 != 0, pick(PARENTS, (eid * 5 + uid) % len(PARENTS)))
    leaf = F.substring_index(F.replace(image, F.lit("/"), F.lit("\\")), "\\", -1)
    parent_leaf = F.substring_index(F.replace(parent, F.lit("/"), F.lit("\\")), "\\", -1)
    command = F.concat(leaf, pick([t[0] for t in TEMPLATES], t_idx), payload,
                       pick([t[2] for t in TEMPLATES], t_idx))
    digest = F.upper(F.md5(eid.cast("string")))
    guid = F.concat(
        F.lit("{"),
        F.concat_ws("-", *[F.substring(digest, a, n)
                           for a, n in [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]]),
        F.lit("}"))
    user = (
        F.when(uid % 11 == 0, "NT AUTHORITY\\SYSTEM")
        .when(uid % 11 == 1, "corp\\svc-ecosystem")
        .otherwise(F.concat(F.lit("CORP\\User"), uid.cast("string"))))
    malicious = F.col("event_type") == "error"
    tech = eid % len(TECHNIQUES)
    return joined.select(
        eid,
        F.when(eid % 89 == 0, "bad-time").otherwise(
            F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("Z"))
        ).alias("UtcTime"),
        guid.alias("ProcessGuid"),
        (F.lit(1000) + eid % 64536).cast("int").alias("ProcessId"),
        image.alias("Image"),
        F.when((eid % 97 != 0) | bound, command).alias("CommandLine"),
        parent.alias("ParentImage"),
        parent_leaf.alias("ParentCommandLine"),
        (F.lit(1000) + (eid * 31) % 64536).cast("int").alias("ParentProcessId"),
        user.alias("User"),
        pick(INTEGRITY, uid % len(INTEGRITY)).alias("IntegrityLevel"),
        malicious.cast("int").alias("is_malicious"),
        F.when(malicious, pick([t[0] for t in TECHNIQUES], tech)).otherwise("")
        .alias("mitre_technique_id"),
        F.when(malicious, pick([t[1] for t in TECHNIQUES], tech)).otherwise("")
        .alias("technique_name"),
        F.when(malicious, "malicious")
        .when(F.col("event_type") == "signup", "gray_area")
        .otherwise("benign").alias("label"),
    )
