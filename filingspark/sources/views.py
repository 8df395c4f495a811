"""The driver's tables as disclosure tables: each view with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Headlines dealt to announcements by number, so that rule chains meet every rule.
TITLES = (
    "Paparan Publik Tahunan Mei 2027",
    "Laporan Keuangan Tengah Tahun 2027",
    "Jadwal  Dividen Tunai",
    "Penjelasan Hak Tagih Perseroan",
    "Rencana Buy Back Tahap Dua",
    "Jatuh Tempo Sukuk Ijarah",
    "Pengunduran Diri Direksi",
    "Panggilan RUPSLB Juni 2027",
    "Koreksi Prospektus Ringkas",
    "Daftar Registrasi Pemegang Efek",
    "Kabar Lain Perseroan",
    "Bukti Iklan rancangan penggabungan usaha dua anak perusahaan",
    "Pemeringkatan Efek oleh Pefindo",
    "Perubahan Kepemilikan Saham",
    "Pencatatan Saham Tambahan",
    "Penghapusan dari Daftar (Delisting)",
    "Akuisisi Entitas Anak",
    "Penjualan Aset Tetap",
    "Gugatan Perkara Hukum",
    "Surat Pernyataan Regulasi",
    "Klarifikasi atas Pemberitaan",
    "Pembukaan Suspensi Perdagangan",
    "Reverse Stock Split",
    "Penambahan Modal PMTHMETD",
    "Laporan Bulanan Registrasi Pemegang Efek",
    " Laporan   Tahunan ",
    "",
)
SUFFIXES = {"en": ".pdf", "de": ".xlsx", "fr": ".docx"}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def announcements(spark: SparkSession, sf_dir: str) -> DataFrame:
    titles = F.array(*map(F.lit, TITLES))
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("announcement_id"),
        F.concat(F.lit("T"), "o_custkey").alias("ticker"),
        F.col("o_orderdate").alias("announced_at"),
        F.col("o_orderpriority").alias("kind"),
        F.col("o_orderstatus").alias("status"),
        F.element_at(titles, (F.col("o_orderkey") % len(TITLES) + 1).cast("int")).alias("title"),
    )


def _quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


ANN = f"""ann as (select o_orderkey as announcement_id, 'T' || o_custkey as ticker, o_orderdate as announced_at, o_orderpriority as kind, o_orderstatus as status,
  [{_quoted(TITLES)}][o_orderkey % {len(TITLES)} + 1] as title from orders)"""


def attachments(spark: SparkSession, sf_dir: str) -> DataFrame:
    suffix = F.coalesce(F.create_map(*[F.lit(x) for kv in SUFFIXES.items() for x in kv])[F.col("lang")], F.lit(".txt"))
    return load(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc:"), "doc_id").alias("url"),
        "doc_id",
        F.col("source").alias("announcement_id"),
        (F.col("doc_id") % 2 == 1).alias("is_attachment"),
        F.concat(F.lit("d"), "doc_id", suffix).alias("filename"),
        F.col("doc_id").alias("ordinal"),
        F.sha2(F.col("text").cast("binary"), 256).alias("sha256"),
        "text",
        "n_chars",
    )


ATT = """att as (select 'doc:' || doc_id as url, doc_id, source as announcement_id, doc_id % 2 = 1 as is_attachment,
  'd' || doc_id || case lang when 'en' then '.pdf' when 'de' then '.xlsx' when 'fr' then '.docx' else '.txt' end as filename,
  doc_id as ordinal, sha256(text) as sha256, text, n_chars from documents)"""


def summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("announcement_id"),
        F.col("l_linenumber").alias("n"),
        F.col("l_returnflag").alias("version"),
        F.col("l_shipdate").alias("updated_at"),
        F.col("l_extendedprice").alias("value"),
    )


SUMS = "sums as (select l_orderkey as announcement_id, l_linenumber as n, l_returnflag as version, l_shipdate as updated_at, l_extendedprice as value from lineitem)"


def audits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").select(
        F.col("event_id").alias("audit_id"),
        F.col("event_type").alias("stage"),
        F.col("user_id").alias("scope"),
        F.col("ts").alias("started_at"),
        F.col("value").alias("elapsed"),
        "props",
    )


AUDIT = "audit as (select event_id as audit_id, event_type as stage, user_id as scope, ts as started_at, value as elapsed, props from events)"


def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six hours of coverage from each event."""
    return load(spark, sf_dir, "events").select(F.col("user_id").alias("scope"), F.col("ts").alias("s"), F.expr("ts + interval 6 hours").alias("e"))


COV = "cov as (select user_id as scope, ts as s, ts + interval 6 hour as e from events)"
