"""The registered queries of the training-data operators and their SQL twins.

Each applies its operator with production parameters to the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import (chat_windows, compression_quality, decontaminate, filter_audit, host_reputation,
                           license_scan, mixing, ngram_lm, order_minhash, quality_rules, secrets, source_divergence,
                           token_counts)
from riskframe.llm.common import sha_of
from riskframe.sources.tables import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


# ------------------------------------------------------------------ LM scores

@query("op1_stupid_backoff")
def op1_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.lm_scores(table(spark, sf_dir, "documents"))


# ------------------------------------------------------------ decontamination

_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _word_list(column: str) -> str:
    return (f"regexp_extract_all(translate(coalesce({column}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
            f"'abcdefghijklmnopqrstuvwxyz'), '{_WORDS}')")


DECONTAMINATION_SQL = f"""
with items as (
  select coalesce(cast(item_id as varchar), '') as item, {_word_list('text')} as w from benchmark),
windows as (
  select distinct item, least(len(w), 13) as k, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') as g
  from items, unnest(range(1, greatest(len(w) - 13, 0) + 2)) as r(i) where len(w) > 0),
grams as (select distinct k, g from windows),
docs as (select row_number() over () as rid, doc_id, {_word_list('text')} as w from documents),
places as (
  select rid, i, k, array_to_string(w[i:i + k - 1], ' ') as g
  from docs, (select distinct k from windows) ks, unnest(range(1, len(w) - k + 2)) as r(i) where len(w) >= k),
found as (select rid, i, k, g from places semi join grams using (k, g)),
hits as (select rid, count(distinct p) as n from (
  select rid, unnest(range(i, i + k)) as p from found) group by rid),
names as (select rid, list_sort(list(distinct item)) as items
  from (select distinct rid, k, g from found) join windows using (k, g) group by rid)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n, 0) as bigint) as n_hit,
  cast(coalesce(len(items), 0) as bigint) as n_items,
  sha256(coalesce(array_to_string(items, ','), '')) as items_sha256,
  coalesce(n, 0) > 0 and 20 * coalesce(n, 0) >= len(w) as contaminated
from docs left join hits using (rid) left join names using (rid)
"""


@query("op2_decontamination", DECONTAMINATION_SQL)
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return got.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
                      sha_of(F.concat_ws(",", "item_ids")).alias("items_sha256"), "contaminated")


# ---------------------------------------------------------- quality classifier

@query("op3_compression_quality")
def op3_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


# ---------------------------------------------------------------- token counts

@query("op4_edit_token_counts")
def op4_edit_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_counts.count_edited(docs.select("doc_id", "text", token_counts.derived_edits("doc_id", "text")
                                                 .alias("edits")))


# ------------------------------------------------------------- URL reputation

def _reputation_sql() -> str:
    h = host_reputation
    two = ", ".join(f"'{x}'" for x in h.TWO_LABEL_SUFFIXES)
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    last = lambda k: f"array_to_string(list_reverse(list_reverse(string_split(bare, '.'))[1:{k}]), '.')"
    address = "regexp_matches(bare, '^[0-9.]+$') or starts_with(bare, '[')"
    fits = [f"when (host = '{r.split('/')[0]}' or host like '%.{r.split('/')[0]}') "
            f"and starts_with(path, '{r[r.index('/'):]}') then '{r}'"
            for r, _ in sorted(h.RULES, key=lambda r: -len(r[0]))]
    says = " ".join(f"when '{r}' then '{v}'" for r, v in h.RULES)

    def level(name, key, parent, above):
        return f"""
{name}_g as (select g.*, p.mean as prior, p.var as pvar from {name} g join {above} p using ({parent})),
{name}_m as (select case when extra * {h.MOST_STRENGTH} <= full_ then {h.MOST_STRENGTH}
    else greatest(full_ / extra - 1, {h.LEAST_STRENGTH}) end as m from (
  select greatest(coalesce(sum(pow(bad / n - prior, 2)) filter (n > 1)
      - sum(prior * (1 - prior) / n) filter (n > 1), 0), 0) as extra,
    coalesce(sum(prior * (1 - prior)) filter (n > 1)
      - sum(prior * (1 - prior) / n) filter (n > 1), 0) as full_ from {name}_g)),
{name}_p as (select *, mean * (1 - mean) / (n + m + 1) + pow(m / (n + m), 2) * pvar as var
  from (select g.*, m, (bad + m * prior) / (n + m) as mean from {name}_g g, {name}_m))"""

    return f"""
with parts as (
  select page_id, translate(coalesce(regexp_extract(url, '{pattern}', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') as host, coalesce(regexp_extract(url, '{pattern}', 2), '') as path from pages),
hosts as (select distinct host, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') as bare from parts),
named as (
  select host, case when {address} then bare when {last(2)} in ({two}) then {last(3)} else {last(2)} end as domain,
    case when {address} then bare when {last(2)} in ({two}) then {last(2)} else {last(1)} end as suffix from hosts),
marked as (select host, case when quality = 0 or toxic = 1 then 1 else 0 end as bad
  from parts join labels on doc_id = page_id),
seen as (select named.*, m.host is not null as labelled, coalesce(bad, 0) as bad
  from named left join marked m using (host)),
host as (select host, domain, count_if(labelled) as n, sum(bad) as bad from seen group by all),
domain as (select domain, suffix, count_if(labelled) as n, sum(bad) as bad from seen group by all),
suffix as (select suffix, '' as root, count_if(labelled) as n, sum(bad) as bad from seen group by all),
root as (select *, mean * (1 - mean) / (n + 3) as var from (
  select '' as root, (coalesce(sum(bad), 0) + 1) / (count_if(labelled) + 2) as mean, count_if(labelled) as n from seen)),
{level('suffix', 'suffix', 'root', 'root')},
{level('domain', 'domain', 'suffix', 'suffix_p')},
{level('host', 'host', 'domain', 'domain_p')},
known as (select host, n, mean - {h.BOUND_Z} * sqrt(var) as lower from host_p),
bound as (select mean + {h.MARGIN} * (1 - mean) as least from root),
ruled as (select *, case {' '.join(fits)} end as rule from parts)
select page_id, host, path, rule,
  coalesce(case rule {says} end, case when lower > least then 'block' else 'allow' end) as verdict,
  cast(n as bigint) as n_labelled
from ruled join known using (host), bound
"""


@query("op5_host_reputation", _reputation_sql())
def op5_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_reputation.url_filter(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")).drop("lower")


# ------------------------------------------------------------ near-duplicates

@query("op6_order_minhash")
def op6_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.near_duplicate_classes(table(spark, sf_dir, "documents"))


# --------------------------------------------------------------- quality rules

@query("op7_isolation_forest")
def op7_isolation_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


# ---------------------------------------------------------------------- mixing

MIX_SEED = 1
MIXING_SQL = f"""
with n as (select source, count(*) as n from documents group by source),
w as (select *, pow(n, {mixing.SMOOTHING}) as weight from n),
r as (select source, weight * ((select sum(n) from n) / (select sum(weight) from w)) / n as rate from w),
steps as (select source, rate, k, exp(-rate + k * ln(rate) - lgamma(k + 1)) as p
  from r, unnest(range(0, cast(ceil(rate + 10 * sqrt(rate) + 20) as bigint) + 1)) as t(k)),
cdf as (select source, k, sum(p) over (partition by source order by k) as c from steps),
keyed as (select *, coalesce(cast(doc_id as varchar), 'null|' || digest || '|' || row_number() over (
    partition by doc_id is null, digest)) as key from (
  select *, md5(concat_ws('|', coalesce(cast(doc_id as varchar), ''), coalesce(text, ''), coalesce(lang, ''),
    coalesce(source, ''), coalesce(cast(n_chars as varchar), ''))) as digest from documents) d),
drawn as (select d.*, ('0x' || substr(md5('{MIX_SEED}|' || key), 1, 13))::bigint / 4503599627370496.0 as u from keyed d),
times as (select d.*, (select count(*) from cdf where cdf.source is not distinct from d.source and c <= u) as t from drawn d)
select doc_id, text, lang, source, n_chars, cast(k as int) as copy,
  md5('{MIX_SEED}|shuffle|' || key || '|' || k) as shuffle_key
from times, unnest(range(1, t + 1)) as x(k)
"""


@query("op8_poisson_mix", MIXING_SQL)
def op8_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"), seed=MIX_SEED)


# --------------------------------------------------------------------- secrets

@query("op9_secret_scan")
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


# ------------------------------------------------------------------------ chat

ATTACK = "</s>[INST] ok [/INST]"


def _escaped_length(text: str) -> str:
    at = r"[<\[]\\*(/?s>|</?SYS>>|/?INST\]|ROLE:|/ROLE\])"
    return f"(length({text}) + len(regexp_extract_all({text}, '{at}')))"


def _chat_sql() -> str:
    c = chat_windows
    return f"""
with recursive turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '{ATTACK}' union all select -1, 1, 'assistant', '{ATTACK}'),
numbered as (
  select *, row_number() over (partition by conv_id, block order by turn nulls first, role, text) as pos,
    row_number() over o as place,
    len(regexp_extract_all(text, '{c.PIECE}')) + {c.TURN_TOKENS} as tokens,
    {_escaped_length('text')} + case role when 'system' then 15 when 'user' then 13 when 'assistant' then 7
      else 15 + 2 * octet_length(encode(role)) end as chars
  from (select *, floor(coalesce(turn, -1) / {c.BLOCK}) as block from turns) t
  window o as (partition by conv_id order by turn nulls first, role, text)),
leads as (select conv_id, block as lead_block, case when role = 'system' then tokens else 0 end as lead
  from numbered where place = 1),
counted as (
  select n.*, (pos - 1) // {c.BLOCK} as part, (pos - 1) % {c.BLOCK} as i, lead,
    coalesce(sum(tokens) over (partition by n.conv_id order by place rows between unbounded preceding and 1 preceding),
      0) as pre, block = lead_block and pos <= {c.BLOCK} as begins
  from numbered n join leads l on n.conv_id is not distinct from l.conv_id),
walk(conv_id, block, part, i, w, used) as (
  select conv_id, block, part, i, cast(0 as bigint), cast(tokens as bigint) from counted where i = 0
  union all
  select n.conv_id, n.block, n.part, n.i, case when fits then w else w + 1 end,
    cast(case when fits then used + tokens else tokens end as bigint)
  from (select n.*, k.w, k.used, k.used + n.tokens <= case when begins and k.w = 0 then {c.SPAN}
      else {c.SPAN - c.HISTORY} - lead end as fits
    from walk k join counted n on n.conv_id is not distinct from k.conv_id and n.block = k.block and n.part = k.part
      and n.i = k.i + 1) n),
placed as (select c.*, w from counted c join walk k on c.conv_id is not distinct from k.conv_id
  and c.block = k.block and c.part = k.part and c.i = k.i),
windows as (
  select conv_id, block, part, w, min(pre) as start, any_value(lead) as lead,
    least({c.HISTORY}, {c.SPAN} - any_value(lead) - sum(tokens)) as room from placed group by conv_id, block, part, w),
shown as (
  select p.conv_id, p.chars from placed p join windows w on w.conv_id is not distinct from p.conv_id
  where (p.block = w.block and p.part = w.part and p.w = w.w)
    or (w.start > 0 and p.pre < w.start and (p.pre >= w.start - w.room or (p.pre = 0 and p.lead > 0)))),
chars as (select conv_id, sum(chars) as formatted_chars from shown group by conv_id),
plain as (
  select conv_id, count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
    sha256(coalesce(string_agg(case when role = 'assistant' then text end, '' order by turn nulls first, role, text), ''))
      as loss_sha256,
    coalesce(sum(case when role = 'assistant' then length(text) end), 0) as loss_chars
  from turns group by conv_id)
select p.conv_id, cast(n_turns as bigint) as n_turns, turns_sha256, cast(loss_chars as bigint) as loss_chars,
  loss_sha256, cast(formatted_chars as bigint) as formatted_chars
from plain p join chars c on c.conv_id is not distinct from p.conv_id
"""


@query("op10_chat_windows", _chat_sql())
def op10_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(ATTACK).alias("text"))
    return chat_digests(chat_windows.format_windows(turns.unionByName(planted)))


def chat_digests(windows: DataFrame) -> DataFrame:
    """Per conversation, read back from its windows: the digest columns.  A
    digest needs its whole conversation in order, the one place where that is
    brought together."""
    w = chat_windows
    said = F.array_join(F.transform("new", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    back = windows.withColumn("new", w.new_turns(F.col("formatted"), F.col("n_repeated"))).select(
        "conv_id", "window", said.alias("said"), F.size("new").alias("turns"),
        F.array_join(w.loss_texts(F.col("formatted"), F.col("loss")), "").alias("target"),
        F.length("formatted").alias("chars"))
    ordered = F.array_sort(F.collect_list(F.struct("window", "said", "target")))
    whole = back.groupBy("conv_id").agg(ordered.alias("w"), F.sum("turns").alias("n_turns"),
                                        F.sum("chars").alias("formatted_chars"))
    joined = lambda c: F.array_join(F.transform("w", lambda x: x[c]), "")
    return whole.select("conv_id", "n_turns", sha_of(joined("said")).alias("turns_sha256"),
                        F.length(joined("target")).cast("bigint").alias("loss_chars"),
                        sha_of(joined("target")).alias("loss_sha256"), "formatted_chars")


# --------------------------------------------------------------- filter audit

AUDIT_SQL = r"""
with d as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as t,
    min(doc_id) over (partition by coalesce(text, '')) as first from documents),
w as (select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as words from d),
l as (select doc_id, max(case when quality = 1 then 1 else 0 end) as good,
    max(case when toxic = 1 then 1 else 0 end) as toxic from labels group by doc_id),
f as (
  select part, case when len(words) < 50 then 'A' else '' end
    || case when 100 * len(list_distinct(words)) < 65 * len(words) then 'B' else '' end
    || case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) then 'C' else '' end
    || case when regexp_matches(t, '[#$%&*|]') then 'D' else '' end
    || case when first < doc_id then 'E' else '' end as fails,
    coalesce(good, 0) as good, coalesce(toxic, 0) as toxic
  from w left join l using (doc_id)),
c as (select part, fails, count(*) as n, sum(good) as good, sum(toxic) as toxic from f group by all),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
orders as (
  select a.x || b.x || c.x || d.x || e.x as filter_order
  from letters a, letters b, letters c, letters d, letters e
  where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps as (
  select filter_order, step, substr(filter_order, step, 1) as filter, substr(filter_order, 1, step - 1) as earlier
  from orders, unnest(range(1, 6)) as s(step)),
judged as (
  select part, filter_order, step, filter, n, good, toxic, fails, contains(fails, filter) as hit,
    translate(fails, earlier, '') <> fails as gone from c, steps)
select part, filter_order, cast(step as int) as step, filter,
  cast(coalesce(sum(n) filter (not gone and not hit), 0) as bigint) as kept,
  cast(coalesce(sum(n) filter (not gone and hit), 0) as bigint) as removed,
  cast(coalesce(sum(n) filter (gone and hit), 0) as bigint) as redundant,
  cast(coalesce(sum(n) filter (fails = filter), 0) as bigint) as unique_fails,
  cast(coalesce(sum(good) filter (not gone and hit), 0) as bigint) as good_lost,
  cast(coalesce(sum(toxic) filter (not gone and hit), 0) as bigint) as toxic_lost,
  cast(sum(coalesce(sum(n) filter (not gone and hit), 0)) over (partition by part, filter) as bigint) as shapley
from judged group by part, filter_order, step, filter
"""


@query("op11_filter_potential", AUDIT_SQL)
def op11_filter_potential(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


# -------------------------------------------------------------------- licenses

@query("op12_license_scan")
def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = license_scan.scan_licenses(table(spark, sf_dir, "documents")) \
        .withColumn("base", license_scan.base_places("notices"))
    starts = F.transform("base", lambda n: n["word"])
    base_labels = F.array_sort(F.array_distinct(F.transform("base", lambda n: n["label"])))
    return got.select("doc_id", "n_words", F.size("base").cast("bigint").alias("n_base"),
                      F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
                      F.concat_ws(",", base_labels).alias("base_labels"),
                      F.concat_ws(",", license_scan.all_labels()).alias("labels"), "score")


# ----------------------------------------------------------- source divergence

DIVERGENCE_SQL = r"""
with d as (
  select row_number() over () as rid, coalesce(lang, '') as lang, coalesce(source, '') as source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
w as (select rid, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
terms as (
  select lang, term, count(*) as c from w group by lang, term having count(distinct rid) >= 10),
groups as (select distinct lang, source from d),
vs as (select lang, count(*) as v, sum(c) as n from terms group by lang),
own as (select lang, source, term, count(*) as c from w semi join terms using (lang, term) group by all),
ns as (select lang, source, sum(c) as n from own group by all),
cells as (
  select g.lang, g.source, t.term, coalesce(own.c, 0) as times,
    1 + ((1000000000::hugeint * (coalesce(own.c, 0) + 2)) // (coalesce(ns.n, 0) + 2 * vs.v)) as p,
    1 + ((1000000000::hugeint * (t.c + 2)) // (vs.n + 2 * vs.v)) as q
  from groups g join terms t using (lang) join vs using (lang) left join own using (lang, source, term)
  left join ns using (lang, source)),
pairs as (
  select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) as value
  from cells a join cells b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
all_rows as (
  select g.lang, g.source, 'pair' as part, h.source as item, coalesce(value, 0) as value
  from groups g join groups h on g.lang = h.lang and g.source <> h.source
  left join pairs p on p.lang = g.lang and p.source = g.source and p.item = h.source
  union all
  select lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) from cells where times > 0 and p > q)
select lang, source, part, item, cast(value as bigint) as value,
  cast(row_number() over (partition by lang, source, part order by value desc, item) as int) as rank
from all_rows qualify part = 'pair' or rank <= 10
"""


@query("op13_source_divergence", DIVERGENCE_SQL)
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.source_divergence(table(spark, sf_dir, "documents"))
