"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm import (
    byte_bpe, decontaminate, katz_lm, language_id, lexical_search, line_dedup, near_dup, periodic_runs, pii, quality_classifier, quality_rules,
    token_files, toxicity)
from marketlens.llm.fitting import labelled_sample
from marketlens.llm.storage import Scratch
from marketlens.llm.text import remainder_of

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

RANKS = "byte_bpe_50k.tiktoken"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(folder).rstrip('/')}/{name}.parquet")


def token_digest(docs: DataFrame) -> DataFrame:
    coded = byte_bpe.encode_decode(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op8_byte_bpe(spark, folder):
    return token_digest(table(spark, folder, "documents"))


@query
def op3_quality_classifier(spark, folder):
    docs, labels = (table(spark, folder, n) for n in ("documents", "labels"))
    weights = quality_classifier.fit(labelled_sample(docs, labels, "quality", remainder_of("doc_id", 5) != 0, quality_classifier.MAX_ROWS))
    return quality_classifier.score(docs, weights).select(
        "doc_id", (remainder_of("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op6_language_id(spark, folder):
    docs = table(spark, folder, "documents")
    network = language_id.fit(docs, remainder_of("doc_id", 5) != 0)
    return language_id.predict(docs, network).select(
        "doc_id", (remainder_of("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


@query
def op9_toxicity(spark, folder):
    docs, labels = (table(spark, folder, n) for n in ("documents", "labels"))
    model = toxicity.fit(toxicity.training_rows(docs, labels, remainder_of("doc_id", 4) != 2))
    return toxicity.score(docs, model).select(
        "doc_id", (remainder_of("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op5_decontaminate(spark, folder):
    docs, items = (table(spark, folder, n) for n in ("documents", "benchmark"))
    found = decontaminate.matches(docs, items).withColumn("n_hit", decontaminate.hit_words())
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


ORACLES["op5_decontaminate"] = r"""
with norm as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark where item_id is not null),
windows as (
  select distinct item_id, least(len(w), 10) as size, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') as gram
  from (select item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) as i from norm where len(w) > 0)),
doc as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents),
grams as (
  select doc_id, i, s.size, array_to_string(list_slice(w, i, i + s.size - 1), ' ') as gram
  from (select doc_id, w, unnest(range(1, len(w) + 1)) as i from doc) d, (select distinct size from windows) s
  where i + s.size - 1 <= len(w)),
hits as (select g.doc_id, g.i, g.size, w.item_id from grams g join windows w on w.gram = g.gram and w.size = g.size),
covered as (select doc_id, count(*) as n_hit from (select distinct doc_id, unnest(range(i, i + size)) as at from hits) group by doc_id),
named as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
          from (select distinct doc_id, cast(item_id as varchar) as item from hits) group by doc_id)
select d.doc_id, cast(len(d.w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
  cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(items, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from doc d left join covered using (doc_id) left join named using (doc_id)
"""


@query
def op4_quality_rules(spark, folder):
    docs, labels = (table(spark, folder, n) for n in ("documents", "labels"))
    trees = quality_rules.fit(labelled_sample(docs, labels, "quality", remainder_of("doc_id", 5) != 0, quality_rules.MAX_ROWS))
    return quality_rules.judge(docs, trees).select("doc_id", *quality_rules.COUNTS, "base_failed", "kept")


@query
def op7_pii(spark, folder):
    docs = table(spark, folder, "documents")
    found = pii.find(docs, pii.fit(docs))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, pii.BASE), F.sha2(pii.spelled(F.filter("spans", lambda s: s["rank"] < len(pii.BASE))), 256).alias("base_sha256"),
        pii.spelled(F.col("spans")).alias("spans"))


@query
def op1_line_dedup(spark, folder):
    return line_dedup.dedup_lines(table(spark, folder, "documents").select("doc_id", "text")).select("doc_id", "n_lines", "n_deleted", "text")


ORACLES["op1_line_dedup"] = rf"""
with cut as (
  select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as pos from documents where text is not null),
lines as (
  select doc_id, pos, line, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as body, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) as words from cut),
numbered as (
  select *, sum(case when words > 0 then 1 else 0 end) over (partition by doc_id order by pos rows unbounded preceding) as n from lines),
worded as (
  select doc_id, n, body, words, sum(words) over (partition by doc_id order by n rows unbounded preceding) as upto from numbered where words > 0),
ends as (
  select a.doc_id, a.n as first, min(b.n) as last from worded a join worded b on a.doc_id = b.doc_id and b.n >= a.n and b.upto - a.upto + a.words >= {line_dedup.MIN_WORDS} group by all
  union
  select b.doc_id, max(a.n) as first, b.n as last from worded a join worded b on a.doc_id = b.doc_id and b.n >= a.n and b.upto - a.upto + a.words >= {line_dedup.MIN_WORDS} group by b.doc_id, b.n),
runs as (
  select e.doc_id, e.first, e.last, string_agg(w.body, chr(10) order by w.n) as content
  from ends e join worded w on w.doc_id = e.doc_id and w.n between e.first and e.last group by all),
ordered as (select *, row_number() over (partition by content order by doc_id, first) as copy from runs),
gone as (select distinct doc_id, unnest(range(cast(first as bigint), cast(last + 1 as bigint))) as n from ordered where copy > 1),
rebuilt as (
  select doc_id, string_agg(line, chr(10) order by pos) as text from numbered l
  where not exists (select 1 from gone g where g.doc_id = l.doc_id and g.n = l.n) group by doc_id),
counted as (select doc_id, count(*) as n_lines from worded group by doc_id),
deleted as (select doc_id, count(*) as n_deleted from gone group by doc_id)
select d.doc_id, cast(coalesce(n_lines, 0) as bigint) as n_lines, cast(coalesce(n_deleted, 0) as bigint) as n_deleted,
  case when d.text is not null then coalesce(r.text, '') end as text
from documents d left join counted using (doc_id) left join deleted using (doc_id) left join rebuilt r using (doc_id)
"""


@query
def op2_minhash_near_dups(spark, folder):
    return near_dup.near_duplicates(table(spark, folder, "documents"), width=4)


@query
def op10_katz_lm(spark, folder):
    docs = table(spark, folder, "documents")
    return katz_lm.katz_scores(docs, remainder_of("doc_id", 10) != 0).select(
        "doc_id", (remainder_of("doc_id", 10) == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op11_rans_token_files(spark, folder):
    files = Scratch(spark, "token-files").folder
    token_files.write(table(spark, folder, "documents"), files, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read(spark, files, with_ids=False).select("doc_id", "start", F.col("n").alias("n_tokens"), F.col("crc32").alias("ids_crc32"))


@query
def op12_lexical_search(spark, folder):
    docs, items = (table(spark, folder, n) for n in ("documents", "benchmark"))
    return lexical_search.search(docs, items)


ORACLES["op12_lexical_search"] = r"""
with doc_terms as (
  select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from documents where text is not null),
sizes as (select doc_id, count(*) as n from doc_terms group by doc_id),
total as (select count(*) as docs, cast(sum(n) as bigint) as terms from sizes),
found as (select doc_id, term, count(*) as tf from doc_terms group by doc_id, term),
weighed as (
  select term, cast(floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)::double)) as bigint) as w
  from (select term, count(*) as df from found group by term), total),
item_terms as (
  select item_id, term, count(*) as times from (
    select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from (select distinct item_id, text from benchmark where text is not null)) group by item_id, term),
scored as (
  select item_id, doc_id, cast(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // terms)))) as bigint) as score
  from item_terms join weighed using (term) join found using (term) join sizes using (doc_id), total group by item_id, doc_id),
ranked as (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scored where score > 0)
select item_id, cast(rank as integer) as rank, doc_id, score from ranked where rank <= 10
"""


def with_period(docs: DataFrame) -> DataFrame:
    """(doc_id, text); in a tenth of the documents the words from one on repeat with a period."""
    hashed = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h")).withColumn(
        "words", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))))
    g, n = F.floor(F.col("h") / 10), F.size("words")
    a = (g % n).cast("int")
    period = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    turned = F.flatten(F.array_repeat(F.slice("words", a + 1, period), F.ceil((n - a) / period).cast("int")))
    changed = F.concat(F.slice("words", F.lit(1), a), F.slice(turned, F.lit(1), n - a))
    return hashed.select("doc_id", F.when(n > 0, F.array_join(changed, " ")).otherwise(F.col("text")).alias("text"))


@query
def op13_periodic_runs(spark, folder):
    found = periodic_runs.find_runs(with_period(table(spark, folder, "documents")))
    # The runs come by start and period, so the first of equal exponents stays.
    best = F.aggregate("runs", F.lit(None).cast(periodic_runs.RUN), lambda top, run: F.when(
        top.isNull() | (run["length"] * top["period"] > top["length"] * run["period"]), run).otherwise(top))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in periodic_runs.RUN.names)), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
