"""Offline sources: raw payloads, manifests with sibling files, reference lists, reports, and a data source for pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.window import Window

ATTACHMENT = "path string, filename string, sourceUrl string, contentType string, sha256 string, metadata map<string,string>"
MANIFEST = f"""schemaVersion string, coverage struct<complete: boolean, startAt: string, endAt: string>, metadata map<string,string>,
disclosures array<struct<externalId: string, ticker: string, announcedAt: string, title: string, subject: string, disclosureType: string, sourceUrl: string,
attachments: array<struct<{", ".join(x.replace(" ", ": ", 1) for x in ATTACHMENT.split(", "))}>>>>"""
REPLY = "pengumuman struct<Id2: string, NoPengumuman: string, TglPengumuman: string, JudulPengumuman: string, JenisPengumuman: string, Kode_Emiten: string, PerihalPengumuman: string, EfekEmiten_Saham: boolean>, attachments array<struct<PDFFilename: string, FullSavePath: string, OriginalFilename: string, IsAttachment: boolean>>"
PAYLOAD = f"ResultCount bigint, Replies array<struct<{REPLY.replace('pengumuman struct', 'pengumuman: struct', 1).replace('attachments array', 'attachments: array', 1)}>>"


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Announcements of raw payload files: the first of each id, with its shard (file), ordinal and the shard's reported total."""
    raw = spark.read.schema(PAYLOAD).json(path, multiLine=True).select(F.col("_metadata.file_path").alias("shard"), F.col("ResultCount").alias("reported"), F.posexplode_outer("Replies").alias("ordinal", "r"))
    p = "r.pengumuman."
    rows = raw.where("r is not null").select(
        "shard", "reported", "ordinal",
        F.col(p + "Id2").alias("id2"),
        F.upper(F.trim(F.col(p + "Kode_Emiten"))).alias("ticker"),
        F.to_utc_timestamp(F.col(p + "TglPengumuman").cast("timestamp"), "Asia/Jakarta").alias("announced_at"),
        F.trim(F.col(p + "JudulPengumuman")).alias("title"),
        F.col("r.attachments").alias("attachments"),
    )
    first = F.row_number().over(Window.partitionBy("id2").orderBy("shard", "ordinal"))
    return rows.withColumn("_n", first).where("_n = 1").drop("_n")


def shard_report(rows: DataFrame) -> DataFrame:
    """(shard, raw, distinct, reported, complete): raw rows prove a shard, as repeated ids collapse."""
    out = rows.groupBy("shard").agg(F.count(F.lit(1)).alias("raw"), F.count_distinct("id2").alias("distinct"), F.max("reported").alias("reported"))
    return out.withColumn("complete", F.col("raw") >= F.col("reported"))


def read_manifest(spark: SparkSession, path: str, start: str, end: str, attest: bool = False, version: str | None = None) -> tuple[DataFrame, bool]:
    """(disclosures in the closed window by time and id, complete).

    Bad manifests, and those of another schema version than the one asked for, are an error; only `attest`
    trusts their completeness.
    """
    raw = spark.read.schema(MANIFEST).json(path, multiLine=True, mode="FAILFAST")
    if version is not None and (other := raw.where(~F.col("schemaVersion").eqNullSafe(F.lit(version))).limit(1).count()):
        raise ValueError(f"manifest: {other} of another schemaVersion than {version}")
    rows = raw.select("schemaVersion", F.explode("disclosures").alias("d")).select("d.*")
    zoned = F.col("announcedAt").rlike(r"(?i)(z|[+-]\d{2}:?\d{2})$")
    bad_path = F.exists("attachments", lambda a: F.startswith(a["path"], F.lit("/")) | a["path"].rlike(r"(^|/)\.\.(/|$)"))
    checks = rows.agg(F.count_if(~zoned).alias("naive"), F.count_if(bad_path).alias("paths"), (F.count("externalId") - F.count_distinct("externalId")).alias("repeated")).first()
    for name, n in checks.asDict().items():
        if n:
            raise ValueError(f"manifest: {n} {name}")
    found = rows.select(F.col("externalId").alias("id2"), F.upper(F.trim("ticker")).alias("ticker"), F.col("announcedAt").cast("timestamp").alias("announced_at"), "title", "subject", F.col("disclosureType").alias("kind"), F.col("sourceUrl").alias("source_url"), "attachments")
    found = found.where(F.col("announced_at").between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp"))).orderBy("announced_at", "id2")
    cover = raw.select("coverage.*").first()
    return found, bool(attest and cover and cover["complete"])


def verify_files(attachments: DataFrame, files: DataFrame) -> DataFrame:
    """attachments (path, sha256) with `status` against files (path, content): ok, missing or mismatch."""
    have = files.select("path", F.sha2("content", 256).alias("_h"))
    return attachments.join(have, "path", "left").withColumn("status", F.when(F.col("_h").isNull(), "missing").when(F.col("sha256").isNotNull() & (F.lower("sha256") != F.col("_h")), "mismatch").otherwise("ok")).drop("_h")


def successful_coverage(reports: DataFrame) -> DataFrame:
    """(scope, s, e) that reports prove: complete, not a no-op or reducer run, no filter, no cap; ends stop at the poll snapshot."""
    good = "status = 'completed' and scrape_complete and not coalesce(noop, false) and coalesce(mode, 'run') = 'run' and keyword is null and max_announcements is null and s <= e"
    return reports.where(good).select("scope", "s", F.least("e", F.coalesce("snapshot", "e")).alias("e")).where("s <= e")


class PagedSource(DataSource):
    """Announcements of paged JSON files, one partition a file: spark.read.format("paged").load(folder)."""

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return "shard string, ordinal int, reported bigint, payload string"

    def reader(self, schema: object) -> DataSourceReader:
        return PagedReader(self.options)


class PagedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        files, folder = _files(self.path)
        found = files.get_file_info(fs.FileSelector(folder))
        prefix = self.path.split("://")[0] + "://" if "://" in self.path else ""
        return [InputPartition(prefix + f.path) for f in sorted(found, key=lambda f: f.path) if f.path.endswith(".json")]

    def read(self, partition: InputPartition):
        import json

        files, path = _files(partition.value)
        with files.open_input_stream(path) as f:
            page = json.loads(f.read())
        for k, reply in enumerate(page.get("Replies") or []):
            yield partition.value, k, page.get("ResultCount"), json.dumps(reply, ensure_ascii=False)


def _files(path: str):
    """(file system, path in it): that of the URL's scheme, or the local one."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
