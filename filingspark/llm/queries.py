"""Registered queries of the training-data operators, over whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import licenses, mixing, top_k
from .conversations import conversation_repair
from .decontaminate import contaminated
from .exact_dedup import exact_dedup
from .hmm import lm_scores
from .language_id import language_id
from .pii import pii_digest
from .simhash import simhash_components
from .token_counts import token_counts
from .toxicity import toxicity
from .variants import variants


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Domains of the tree: sources by number, in turn.
DOMAINS = ("web", "books", "forums", "reference")
#: Target weights by (domain, lang, source); what isn't listed has weight 1.
WEIGHTS = (
    ("web", None, None, 4),
    ("books", None, None, 3),
    ("forums", None, None, 2),
    ("reference", None, None, 6),
    ("web", "en", None, 5),
    ("web", "de", None, 2),
    ("books", "en", None, 3),
    ("books", "fr", None, 2),
    ("forums", "en", None, 6),
    ("reference", "en", None, 4),
    ("reference", "es", None, 3),
    ("web", "en", "src0", 2),
    ("web", "de", "src4", 3),
    ("books", "en", "src1", 2),
)
SEED, FRACTION, MAX_EPOCHS = 17, 0.8, 3


def domain(source: Column) -> Column:
    """Domain by the number that ends a source's name; without one, the last."""
    n = F.coalesce(F.regexp_extract(source, r"([0-9]{1,9})$", 1).try_cast("int"), F.lit(len(DOMAINS) - 1))
    return F.element_at(F.array(*map(F.lit, DOMAINS)), n % len(DOMAINS) + 1)


def weights(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(WEIGHTS), "domain string, lang string, source string, weight long")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", domain(F.col("source")).alias("domain"), "lang", "source", "text")
    return mixing.mix(docs, weights(spark), fraction=FRACTION, max_epochs=MAX_EPOCHS, seed=SEED)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op6_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_digest(table(spark, sf_dir, "documents"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), tokenizer_path())


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


def op11_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair(table(spark, sf_dir, "conversations"))


NUMBERED = (op1_mixing, op2_decontamination, op3_language_id, op4_toxicity, op5_exact_dedup, op6_lm_scores, op7_pii, op8_licenses, op9_token_counts, op10_simhash, op11_top_k, op12_variants, op13_conversation_repair)


def queries() -> dict:
    return {f.__name__: f for f in NUMBERED}


EXACT_DEDUP = r"""
with n as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as norm from documents)
select doc_id, min(doc_id) over (partition by norm) as keep_id, count(*) over (partition by norm) as group_size,
  row_number() over (partition by norm order by doc_id) = 1 as kept, sha256(norm) as text_sha256
from n
"""


def mixing_sql() -> str:
    """Budgets level by level, then the documents of each epoch, all in DuckDB."""
    rows = ", ".join("(" + ", ".join("null" if x is None else f"'{x}'" if isinstance(x, str) else str(x) for x in r) + ")" for r in WEIGHTS)
    number = f"coalesce(try_cast(nullif(regexp_extract(source, '([0-9]{{1,9}})$', 1), '') as integer), {len(DOMAINS) - 1})"

    def level(k: int) -> str:
        path = ", ".join(mixing.LEVELS[: k + 1])
        parent = ", ".join(mixing.LEVELS[:k]) or "1"
        name = mixing.LEVELS[k]
        deeper = " and ".join(f"w.{x} is null" for x in mixing.LEVELS[k + 1 :]) or "true"
        same = " and ".join(f"w.{x} = n.{x}" for x in mixing.LEVELS[: k + 1])
        above = f"join b{k - 1} using ({parent})" if k else "cross join (select least((select total from whole), sum(cap)) as budget from leaves)"
        return f"""
n{k} as (select {path}, sum(cap)::hugeint as cap from leaves group by {path}),
w{k} as (select n.*, coalesce(w.weight, 1)::hugeint as weight from n{k} n left join weights w on {same} and {deeper}),
i{k} as (select *, budget::hugeint as total from w{k} {above}),
o{k} as (select *, coalesce(sum(cap) over p, 0)::hugeint as caps, sum(weight) over r as open_weights from i{k} where weight > 0 and cap > 0
  window p as (partition by {parent} order by cap / weight::double, cap, {name} rows between unbounded preceding and 1 preceding),
  r as (partition by {parent} order by cap / weight::double, cap, {name} rows between current row and unbounded following)),
f{k} as (select *, cap * open_weights <= greatest(total - caps, 0) * weight as is_full from o{k}),
u{k} as (select *, coalesce(sum(cap) filter (where is_full) over (partition by {parent}), 0)::hugeint as used, sum(weight) filter (where not is_full) over (partition by {parent}) as open from f{k}),
g{k} as (select *, case when is_full then cap else ((total - used) * weight // open)::hugeint end as part from u{k}),
b{k} as (select {path}, part + case when not is_full and row_number() over (partition by {parent} order by is_full, {name}) <= total - sum(part) over (partition by {parent}) then 1 else 0 end as budget from g{k})"""

    return rf"""
with recursive weights(domain, lang, source, weight) as (values {rows}),
slim as (select doc_id, [{", ".join(f"'{d}'" for d in DOMAINS)}][{number} % {len(DOMAINS)} + 1] as domain, coalesce(lang, '') as lang, coalesce(source, '') as source,
  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as n_tokens from documents),
leaves as (select domain, lang, source, sum(n_tokens)::bigint as tokens, sum(n_tokens)::hugeint * {MAX_EPOCHS} as cap from slim where n_tokens > 0 group by all),
whole as (select floor(sum(tokens)::double * {FRACTION})::hugeint as total from leaves),
{", ".join(level(k) for k in range(3))},
plan as (select domain, lang, source, tokens, (budget // tokens)::integer as rounds, (budget % tokens)::bigint as rest from leaves join b2 using (domain, lang, source) where budget > 0),
rows as (select * from slim join plan using (domain, lang, source) where n_tokens > 0),
past as (select *, rounds + 1 as epoch, coalesce(sum(n_tokens) over (partition by domain, lang, source
  order by md5('{SEED}:' || (rounds + 1) || ':' || coalesce(doc_id::varchar, 'null')), n_tokens rows between unbounded preceding and 1 preceding), 0) as before from rows where rest > 0)
select doc_id, domain, lang, source, unnest(range(1, rounds + 1))::integer as epoch, n_tokens, n_tokens as taken from rows where rounds > 0
union all
select doc_id, domain, lang, source, epoch::integer, n_tokens, least(n_tokens, rest - before)::bigint as taken from past where before < rest
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_mixing": mixing_sql(), "op5_exact_dedup": EXACT_DEDUP, "op8_licenses": licenses.oracle_sql(), "op11_top_k": top_k.ORACLE}
