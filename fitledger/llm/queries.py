"""The registered queries of this subpackage, and SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fitledger.session import saved_table, scratch_path

URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def url_filters(spark, sf_dir):
    from fitledger.llm.url_rules import judge_urls

    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge_urls(_table(spark, sf_dir, "pages"), rules)


def token_counts(spark, sf_dir):
    import public_tokenizers

    from fitledger.llm.token_counts import count_tokens, create_cache

    cache, model = scratch_path(spark, "token-counts"), public_tokenizers.path("piece_bpe_32k.model")
    create_cache(spark, cache)
    documents = _table(spark, sf_dir, "documents")
    # All documents in two calls over one cache: what the first has counted, the second finds there.
    odd = F.coalesce(F.col("doc_id") % 2 != 0, F.lit(True))
    return count_tokens(documents.where(~odd), cache, model).unionByName(count_tokens(documents.where(odd), cache, model))


def source_mix(spark, sf_dir):
    from fitledger.llm.mixing import mix

    return mix(_table(spark, sf_dir, "documents"))


def warc_packages(spark, sf_dir):
    from fitledger.llm.archive import read_archives, urn_id, with_revisits, write_archives

    records = with_revisits(_table(spark, sf_dir, "pages"))
    manifest = saved_table(write_archives(records, scratch_path(spark, "packages")), "packages-manifest")
    return read_archives(manifest).select(
        urn_id("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        urn_id("refers_to").alias("refers_to"))


def benchmark_decontamination(spark, sf_dir):
    from fitledger.llm.decontaminate import contamination

    return contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def quality_scores(spark, sf_dir):
    from fitledger.llm.quality import THRESHOLD, fit_quality, score_quality

    documents = _table(spark, sf_dir, "documents")
    weights = fit_quality(documents, _table(spark, sf_dir, "labels"))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return score_quality(documents, weights).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def language_predictions(spark, sf_dir):
    from fitledger.llm.language import fit_language, predict_language

    documents = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    return predict_language(documents, fit_language(documents)).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score")


def near_duplicate_documents(spark, sf_dir):
    from fitledger.llm.near_dup import near_duplicates

    # A pair of similarity 0.85 shares no band with a chance below 1e-7.
    return near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, percent=85, bands=28, band_rows=5)


def nearest_vectors(spark, sf_dir):
    from fitledger.llm.neighbours import nearest

    return nearest(_table(spark, sf_dir, "embeddings"))


def main_texts(spark, sf_dir):
    from fitledger.llm.extraction import extract_main_text, fit_extraction

    return extract_main_text(_table(spark, sf_dir, "pages"), fit_extraction())


def conversation_repairs(spark, sf_dir):
    from fitledger.llm.conversation_repair import repair_conversations, turn_gaps

    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    text = F.coalesce("text", F.lit(" "))
    rows = _table(spark, sf_dir, "conversations").withColumn("damage", F.crc32(key) % 20)
    there = F.col("damage") != 0
    damaged = rows.where(there).select(
        "conv_id", "turn", F.when(F.col("damage") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("damage") == 1, "").when(F.col("damage") == 2, F.regexp_replace(text, "[.!?]", ""))
        .otherwise(text).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("damage") == 3, 2).otherwise(1))))
    done = repair_conversations(damaged).where("position is null").withColumnRenamed("conv_id", "repaired")
    zeros = [F.coalesce(c, F.lit(0)).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    return turn_gaps(rows, counted=there).join(done, F.col("conv_id").eqNullSafe(F.col("repaired")), "left").select(
        "conv_id", "gaps", *zeros, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def _planted(documents: DataFrame) -> DataFrame:
    """Documents of which each tenth, by its id, repeats a stretch of its words up to its end."""
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    chosen = documents.withColumns({"_words": F.when(h % 10 == 0, words), "_g": g})
    n = F.size("_words")
    chosen = chosen.withColumn("_n", n).withColumn("_a", F.when(F.col("_n") > 0, F.col("_g") % F.col("_n")).cast("int"))
    chosen = chosen.withColumn("_p", F.expr("cast(1 + (_n - _a) div (3 + _g % 8) as int)"))
    repeated = F.expr("""
        concat(slice(_words, 1, _a),
               slice(flatten(array_repeat(slice(_words, _a + 1, _p), cast(ceil((_n - _a) / _p) as int))), 1, _n - _a))""")
    text = F.when(F.col("_n") > 0, F.array_join(repeated, " ")).otherwise(F.col("text"))
    return chosen.select("doc_id", text.alias("text"))


def word_runs(spark, sf_dir):
    from fitledger.llm.periodic_runs import periodic_runs

    found = periodic_runs(_planted(_table(spark, sf_dir, "documents")))
    # The greatest length, then the least start and period.
    ranked = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"),
                                                    (-r["period"]).alias("period")))
    best = found.withColumn("best", F.array_max(ranked))
    length, start, period = F.col("best.length"), -F.col("best.start"), -F.col("best.period")
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), start.alias("start"), length.alias("length"),
        period.alias("period"), F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def secret_scans(spark, sf_dir):
    from fitledger.llm.secret_scan import KINDS, find_secrets

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of(*kinds):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    counts = [F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in KINDS[:3]]
    return find_secrets(_table(spark, sf_dir, "documents")).select(
        "doc_id", *counts, F.sha2(joined(of(*KINDS[:3])), 256).alias("base_sha256"), joined("spans").alias("spans"))


QUERIES = {
    "op1_main_texts": main_texts,
    "op2_url_filters": url_filters,
    "op3_nearest_vectors": nearest_vectors,
    "op4_source_mix": source_mix,
    "op5_quality_scores": quality_scores,
    "op6_near_duplicates": near_duplicate_documents,
    "op7_language_predictions": language_predictions,
    "op8_warc_packages": warc_packages,
    "op10_benchmark_decontamination": benchmark_decontamination,
    "op9_token_counts": token_counts,
    "op11_conversation_repairs": conversation_repairs,
    "op12_periodic_runs": word_runs,
    "op13_secret_scans": secret_scans,
}

URL_SQL = """
with parts as (
    select page_id,
           case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) end as rest
    from pages
), cut as (
    select page_id,
           translate(coalesce(regexp_extract(rest, '^[^/?#]*'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz') as host,
           coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') as path
    from parts
), rules(rule_host, rule_path, rule_verdict) as (
    values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
           ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), sites as (
    select distinct host, path from cut
), fits as (
    select host, path, rule_host || rule_path as rule, rule_verdict as verdict,
           row_number() over (partition by host, path
                              order by length(rule_host || rule_path) desc, length(rule_host) desc) as place
    from sites join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
)
select page_id, cut.host, cut.path, rule, coalesce(verdict, 'allow') as verdict
from cut left join (select * from fits where place = 1) best
  on cut.host = best.host and cut.path = best.path
"""

MIX_SQL = """
with recursive sized as (
    select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as size,
           ('0x' || substr(md5('0:' || coalesce(doc_id::varchar, '')), 1, 15))::bigint as seeded
    from documents
), sources as (
    select source, sum(size)::bigint as source_size,
           [5, 2, 1][1 + (row_number() over (order by source nulls last) - 1) % 3] as weight
    from sized group by source
), shared as (
    select 0 as step, source, source_size, weight, null::double as fixed,
           (select sum(size) from sized)::double * weight / (select sum(weight) from sources) as want
    from sources
    union all
    select step + 1, source, source_size, weight, fixed_now,
           coalesce(fixed_now, ((select sum(size) from sized)::double - coalesce(sum(fixed_now) over (), 0)) * weight
               / sum(case when fixed_now is null then weight end) over ())
    from (select *, case when fixed is not null or want > 3 * source_size then 3.0 * source_size end as fixed_now,
                 bool_or(fixed is null and want > 3 * source_size) over () as again
          from shared)
    where again
), targets as (
    select source, source_size, want as target, round(want)::bigint as tokens
    from shared where step = (select max(step) from shared)
), ordered as (
    select s.*, t.source_size, t.target, t.tokens,
           coalesce(sum(size) over (partition by s.source order by seeded, doc_id, size
                                    rows between unbounded preceding and 1 preceding), 0)::bigint as before
    from sized s join targets t on s.source is not distinct from t.source
)
select doc_id, size, source_size, target,
       (case when source_size = 0 then 0
             else size * (tokens // source_size)
                  + least(size, greatest(tokens % source_size - before, 0)) end)::bigint as taken
from ordered
"""

PACKAGES_SQL = """
with paid as (
    select page_id, coalesce(html, '') as payload, sha1(coalesce(html, '')) as digest,
           min(page_id) over (partition by coalesce(html, '')) as first
    from pages
)
select page_id, octet_length(encode(payload))::bigint as payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((('0x' || substr(digest, (i // 4 * 5 + 1)::int, 5))::bigint >> (15 - 5 * (i % 4))::int) & 31)::int + 1, 1) for i in range(32)],
           '') as payload_digest,
       case when page_id = first then 'response' else 'revisit' end as record_type,
       case when page_id <> first then first end as refers_to
from paid
"""

_WORDS = (r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

DECONTAMINATION_SQL = f"""
with items as (
    select distinct item_id::varchar as item_id, {_WORDS.format("text")} as words
    from benchmark where item_id is not null and text is not null
), docs as (
    select row_number() over () as row, doc_id, {_WORDS.format("coalesce(text, '')")} as words from documents
), windows as (
    select distinct item_id, n, array_to_string(words[k:k + n - 1], ' ') as window
    from (select item_id, words, n, unnest(range(1, len(words) - n + 2)) as k
          from (select item_id, words, least(len(words), 10) as n from items where len(words) > 0))
), spots as (
    select row, k, n, array_to_string(words[k:k + n - 1], ' ') as window
    from (select row, words, n, unnest(range(1, len(words) - n + 2)) as k
          from docs, (select distinct n from windows))
), found as (
    select row, k, spots.n, item_id from spots join windows on spots.n = windows.n and spots.window = windows.window
), hit as (
    select row, count(distinct word) as n_hit
    from (select row, unnest(range(k, k + n)) as word from (select distinct row, k, n from found)) group by row
), named as (
    select row, count(*) as n_items, string_agg(item_id, ',' order by item_id) as names
    from (select distinct row, item_id from found) group by row
)
select doc_id, len(words)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
       coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(names, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated
from docs left join hit using (row) left join named using (row)
"""

REPAIR_SQL = r"""
with recursive crc_table as (
    select list_transform(range(256), lambda b: list_reduce(range(8), lambda c, i:
        case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, b)) as t
), keyed as (
    select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
           coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as key
    from conversations
), hashed as (
    select k.*, xor(list_reduce(list_transform(string_split(key, ''), lambda s: ascii(s)::bigint), lambda c, b:
        xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::bigint), 4294967295) % 20 as damage
    from keyed k, crc_table
), damaged as (
    select conv_id, turn, case when damage = 4 then 'user' else role end as role,
           case damage when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
           unnest(range(case damage when 0 then 0 when 3 then 2 else 1 end))
    from hashed
), placed as (
    select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as place,
           right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) as ending
    from damaged
), coded as (
    select conv_id, place, turn, role, text, left(role, 1) as letter,
           case when ending = '' then 'blank'
                when row_number() over (partition by conv_id, role, text order by place) > 1 then 'duplicate'
                when ending not in ('.', '!', '?') then 'truncated' else '' end as fault,
           lag(left(role, 1)) over (partition by conv_id order by place) as before
    from placed
), counted as (
    select conv_id, count(*) as n, count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
           count(*) filter (fault = 'truncated') as truncated,
           count(*) filter (before is not null and before || letter not in ('su', 'ua', 'au')) as illegal,
           coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps
    from coded group by conv_id
), steps(state, letter, next, written) as (
    values ('x', 's', 's', ''), ('x', 'u', 'u', 'user'), ('s', 'u', 'u', 'user'), ('u', 'a', 'a', 'assistant'), ('a', 'u', 'u', 'user')
), inserted(state, letters, cost, next, rows) as (
    select distinct state, '', 0, state, []::varchar[] from (select state from steps union select next from steps)
    union all select state, 'I', 5, next, [written || ':'] from steps where written <> ''
    union all select a.state, 'II', 10, b.next, [a.written || ':', b.written || ':']
              from steps a join steps b on a.next = b.state where a.written <> '' and b.written <> ''
), edits as (
    select c.conv_id, c.place, s.state, s.next, e.letter, e.cost, e.rows
    from coded c
    cross join (select distinct state, state as next, '' as reads, '' as written from inserted
                union all select state, next, letter, written from steps) s,
    lateral (
        select 'D' as letter, 2 as cost, []::varchar[] as rows where s.reads = ''
        union all select 'K', case fault when 'truncated' then 5 else 0 end, [role || ':' || text]
                  where s.reads = c.letter and s.reads <> '' and fault not in ('blank', 'duplicate')
        union all select 'R', 1 + case fault when 'truncated' then 5 else 0 end, [s.written || ':' || text]
                  where s.written <> '' and fault not in ('blank', 'duplicate')
    ) e
), walk as (
    select distinct conv_id, 0::bigint as place, 'x' as state, 0::bigint as cost, '' as audit, []::varchar[] as rows from coded
    union all
    select conv_id, place, state, cost, audit, rows from (
        select w.conv_id, e.place, e.next as state, w.cost + i.cost + e.cost as cost, w.audit || i.letters || e.letter as audit,
               w.rows || i.rows || e.rows as rows,
               row_number() over (partition by w.conv_id, e.next
                                  order by w.cost + i.cost + e.cost, w.audit || i.letters || e.letter) as rank
        from walk w join inserted i on i.state = w.state
        join edits e on e.conv_id is not distinct from w.conv_id and e.place = w.place + 1 and e.state = i.next)
    where rank = 1
), ends as (
    select w.conv_id, w.cost + i.cost as cost, w.audit || i.letters as audit, w.rows || i.rows as rows,
           row_number() over (partition by w.conv_id order by w.cost + i.cost, w.audit || i.letters) as rank
    from walk w join counted c on c.conv_id is not distinct from w.conv_id and c.n = w.place
    join inserted i on i.state = w.state and i.next in ('x', 'a')
)
select o.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
       coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, coalesce(cost, 0)::bigint as cost,
       coalesce(audit, '') as audit, sha256(coalesce(array_to_string(rows, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) o
left join counted c on c.conv_id is not distinct from o.conv_id
left join ends e on e.conv_id is not distinct from o.conv_id and e.rank = 1
"""

RUNS_SQL = r"""
with crc_table as (
    select list_transform(range(256), lambda b: list_reduce(range(8), lambda c, i:
        case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, b)) as t
), numbered as (
    select row_number() over () as row, doc_id, regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') as words,
           xor(list_reduce(list_transform(string_split(doc_id::varchar, ''), lambda s: ascii(s)::bigint), lambda c, b:
               xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::bigint), 4294967295) as h
    from documents, crc_table
), chosen as (
    select *, len(words) as n, case when h % 10 = 0 and len(words) > 0 then (h // 10) % len(words) end as a from numbered
), spread as (
    select row, doc_id, a, 1 + (n - a) // (3 + (h // 10) % 8) as p, words, unnest(range(n)) as i from chosen
), placed as (
    select row, i, case when a is null or i < a then words[i + 1] else words[a + (i - a) % p + 1] end as word from spread
), lengths as (
    select row, count(*) as n from placed group by row
), alike as (
    select x.row, x.i, y.i - x.i as q
    from placed x join placed y on x.row = y.row and x.word = y.word and y.i > x.i
    join lengths l on l.row = x.row where y.i - x.i <= l.n // 2
), stretches as (
    select row, q, min(i) as start, count(*) + q as length
    from (select *, i - row_number() over (partition by row, q order by i) as stretch from alike)
    group by row, q, stretch having count(*) + q >= greatest(12, 2 * q)
), runs as (
    select row, start, length, min(q) as period from stretches group by row, start, length
), best as (
    select row, count(*) as n_runs, arg_min((start, length, period), (-length, start, period)) as top,
           string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as listed
    from runs group by row
), gone as (
    select distinct row, unnest(range(start + period, start + length)) as i from runs
), kept as (
    select row, string_agg(word, ' ' order by i) as text from placed anti join gone using (row, i) group by row
)
select doc_id, coalesce(n_runs, 0)::bigint as n_runs, top[1]::bigint as start, top[2]::bigint as length, top[3]::bigint as period,
       (1000 * top[2] // top[3])::bigint as exponent_milli, sha256(coalesce(listed, '')) as runs_sha256,
       sha256(coalesce(kept.text, '')) as collapsed_sha256
from chosen left join best using (row) left join kept using (row)
"""

SQL = {"op11_conversation_repairs": REPAIR_SQL, "op12_periodic_runs": RUNS_SQL,
       "op2_url_filters": URL_SQL, "op4_source_mix": MIX_SQL, "op8_warc_packages": PACKAGES_SQL,
       "op10_benchmark_decontamination": DECONTAMINATION_SQL}
