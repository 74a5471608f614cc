"""Registered queries of the operators and their SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonearm.llm import lines
from tonearm.llm.common import table
from tonearm.llm.conversations import damaged, repair_conversations, turn_digests
from tonearm.llm.fingerprints import fingerprint_documents
from tonearm.llm.licenses import scan_licenses
from tonearm.llm.mixing import mix_sources
from tonearm.llm.near_dedup import near_duplicates
from tonearm.llm.packing import best_fit_packing
from tonearm.llm.quality import quality_scores
from tonearm.llm.search import top_documents
from tonearm.llm.spelling import counted_words, misspelt_words, spelling_forms
from tonearm.llm.substrings import remove_repeats
from tonearm.llm.token_counts import token_counts
from tonearm.llm.vectors import nearest_vectors

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_substring_dedup(spark, sf_dir):
    kept = remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


ORACLES["op1_substring_dedup"] = r"""
with split_text as (
    select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents
),
numbered as (
    select doc_id, unnest(words) as word, unnest(range(1, len(words) + 1)) as pos from split_text
),
windows as (
    select doc_id, low, array_to_string(words[low:low + 34], ' ') as content
    from (select doc_id, words, unnest(range(1, len(words) - 33)) as low from split_text where len(words) >= 35)
),
repeated as (
    select doc_id, low from (select doc_id, low, count(*) over (partition by content) as places from windows)
    where places > 1
),
gone as (
    select distinct doc_id, low + step as pos
    from repeated cross join (select unnest(range(0, 35)) as step)
),
judged as (
    select n.doc_id, n.pos, n.word, g.pos is not null as removed
    from numbered n left join gone g on n.doc_id = g.doc_id and n.pos = g.pos
),
kept as (
    select doc_id, count(*) filter (where removed) as n_removed,
        string_agg(word, ' ' order by pos) filter (where not removed) as text
    from judged group by doc_id
)
select s.doc_id, cast(len(words) as bigint) as n_words, coalesce(n_removed, 0) as n_removed,
    sha256(coalesce(k.text, '')) as kept_sha256
from split_text s left join kept k on s.doc_id = k.doc_id
"""


@query
def op2_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = lines.apply_bitmaps(docs, lines.keep_bitmaps(docs))
    return kept.select("row.doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


ORACLES["op2_line_dedup"] = r"""
with split_text as (
    select doc_id, string_split(coalesce(text, ''), chr(10)) as all_lines from documents
),
numbered as (
    select doc_id, unnest(all_lines) as line, unnest(range(1, len(all_lines) + 1)) as pos from split_text
),
keyed as (
    select doc_id, pos, line,
        translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as line_key
    from numbered
),
repeated as (
    select line_key, max(doc_id) as keeper from keyed where length(line_key) >= 20
    group by line_key having count(distinct doc_id) >= 3
),
judged as (
    select doc_id, pos, line, coalesce(doc_id < keeper, false) as dropped
    from keyed left join repeated using (line_key)
)
select doc_id, count(*) as n_lines, count(*) filter (where dropped) as n_dropped,
    sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not dropped), '')) as kept_sha256
from judged group by doc_id
"""


@query
def op3_license_scan(spark, sf_dir):
    return scan_licenses(table(spark, sf_dir, "documents"))


@query
def op4_best_fit_packing(spark, sf_dir):
    return best_fit_packing(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op5_exact_search(spark, sf_dir):
    return top_documents(table(spark, sf_dir, "documents"))


@query
def op6_source_mix(spark, sf_dir):
    return mix_sources(table(spark, sf_dir, "documents"))


@query
def op7_token_counts(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op8_quality(spark, sf_dir):
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op9_near_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), percent=80, width=2)


ORACLES["op9_near_dedup"] = r"""
with recursive split_text as (
    select doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'
    ) as words
    from documents
),
shingles as (
    select distinct doc_id, words[i] || ' ' || coalesce(words[i + 1], '') as shingle
    from (select doc_id, words, unnest(range(1, greatest(2, len(words)))) as i from split_text where len(words) > 0)
),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
shared as (
    select a.doc_id as a, b.doc_id as b, count(*) as n
    from shingles a join shingles b on a.shingle = b.shingle and a.doc_id < b.doc_id
    group by a.doc_id, b.doc_id
),
links as (
    select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b
    where 100 * shared.n >= 80 * (x.n + y.n - shared.n)
),
both_ways as (select a, b from links union all select b, a from links),
reach(a, b) as (
    select a, b from both_ways
    union
    select r.a, w.b from reach r join both_ways w on r.b = w.a
),
smallest as (select a as doc_id, min(b) as least from reach group by a)
select s.doc_id, coalesce(z.n, 0) as n_shingles, least(s.doc_id, coalesce(m.least, s.doc_id)) as component_id,
    s.doc_id <= coalesce(m.least, s.doc_id) as kept
from split_text s left join sizes z on s.doc_id = z.doc_id left join smallest m on s.doc_id = m.doc_id
"""


@query
def op10_fingerprints(spark, sf_dir):
    return fingerprint_documents(table(spark, sf_dir, "documents"))


@query
def op11_conversation_repair(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    audits, turns = repair_conversations(damaged(rows))
    ids = rows.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    digests = turn_digests(turns).withColumnRenamed("conv_id", "d_conv")
    found = ids.join(audits.withColumnRenamed("conv_id", "a_conv"), F.col("conv_id").eqNullSafe(F.col("a_conv")), "left")
    found = found.join(digests, F.col("conv_id").eqNullSafe(F.col("d_conv")), "left")
    return found.select(
        "conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


ORACLES["op11_conversation_repair"] = r"""
with recursive hashed as (
    select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
        hex(encode(coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' '))) as digits
    from conversations
),
bits as (
    select conv_id, turn, role, text, flatten(list_transform(range(0, length(digits) // 2), lambda i: list_transform(range(0, 8),
        lambda j: ((instr('0123456789ABCDEF', substr(digits, cast(2 * i + if(j < 4, 2, 1) as bigint), 1)) - 1) >> cast(j % 4 as integer)) & 1))) as bits
    from hashed
),
damage as (
    select conv_id, turn, role, text, xor(4294967295, list_reduce(list_prepend(cast(4294967295 as bigint), bits),
        lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1)))) % 20 as what
    from bits
),
kept as (
    select conv_id, turn, if(what = 4, 'user', role) as role,
        case what when 1 then '' when 2 then translate(text, '.!?', '') else text end as text
    from damage cross join (values (0), (1)) as copies(copy)
    where what <> 0 and (copy = 0 or what = 3)
),
placed as (
    select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as pos from kept
),
judged as (
    select conv_id, turn, role, text, pos,
        case when not regexp_matches(text, '[^\x20\x09-\x0D]') then 'blank'
            when row_number() over (partition by conv_id, role, text order by pos) > 1 then 'duplicate'
            when not regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') then 'truncated' else '' end as fault,
        lag(left(role, 1)) over (partition by conv_id order by pos) || left(role, 1) as pair
    from placed
),
ways(state, initial, after) as (values (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
dues(state, role, after) as (values (0, 'user', 2), (1, 'user', 2), (2, 'assistant', 3), (3, 'user', 2)),
inserts(state, after, cost, letters, lines) as (
    values (0, 0, 0, '', []), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []),
        (0, 2, 5, 'I', ['user:']), (1, 2, 5, 'I', ['user:']), (2, 3, 5, 'I', ['assistant:']), (3, 2, 5, 'I', ['user:']),
        (0, 3, 10, 'II', ['user:', 'assistant:']), (1, 3, 10, 'II', ['user:', 'assistant:'])
),
edits as (
    select conv_id, pos, state, state as after, 2 as cost, 'D' as letter, [] as lines
    from judged cross join (select distinct state from dues)
    union all
    select conv_id, pos, state, after, if(fault = 'truncated', 5, 0), 'K', [role || ':' || text]
    from judged join ways on initial = left(role, 1) where fault in ('', 'truncated')
    union all
    select conv_id, pos, state, after, if(fault = 'truncated', 6, 1), 'R', [dues.role || ':' || text]
    from judged cross join dues where fault in ('', 'truncated')
),
paths as (
    select distinct conv_id, cast(0 as bigint) as pos, 0 as state,
        {'cost': cast(0 as bigint), 'audit': '', 'lines': cast([] as varchar[])} as best
    from judged
    union all
    select p.conv_id, p.pos + 1, e.after, min({'cost': p.best.cost + i.cost + e.cost,
        'audit': p.best.audit || i.letters || e.letter, 'lines': p.best.lines || i.lines || e.lines})
    from paths p join inserts i on i.state = p.state
    join edits e on e.conv_id is not distinct from p.conv_id and e.pos = p.pos + 1 and e.state = i.after
    group by p.conv_id, p.pos, e.after
),
counts as (
    select conv_id, max(pos) as n, count(*) filter (where fault = 'blank') as blank,
        count(*) filter (where fault = 'duplicate') as duplicate, count(*) filter (where fault = 'truncated') as truncated,
        count(*) filter (where pair not in ('su', 'ua', 'au')) as illegal,
        coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps
    from judged group by conv_id
),
ends as (
    select p.conv_id, min({'cost': p.best.cost + i.cost, 'audit': p.best.audit || i.letters, 'lines': p.best.lines || i.lines}) as best
    from paths p join counts c on c.conv_id is not distinct from p.conv_id and c.n = p.pos
    join inserts i on i.state = p.state where i.after in (0, 3) group by p.conv_id
)
select o.conv_id, coalesce(c.gaps, 0) as gaps, coalesce(c.blank, 0) as blank, coalesce(c.duplicate, 0) as duplicate,
    coalesce(c.truncated, 0) as truncated, coalesce(c.illegal, 0) as illegal, coalesce(e.best.cost, 0) as cost,
    coalesce(e.best.audit, '') as audit, sha256(coalesce(array_to_string(e.best.lines, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) o
left join counts c on c.conv_id is not distinct from o.conv_id
left join ends e on e.conv_id is not distinct from o.conv_id
"""


@query
def op12_spelling_variants(spark, sf_dir):
    return spelling_forms(counted_words(misspelt_words(table(spark, sf_dir, "documents"))))


ORACLES["op12_spelling_variants"] = r"""
with recursive runs as (
    select doc_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]{7,}')) as run
    from documents
),
told as (
    select doc_id, run, count(*) as places, hex(encode(coalesce(cast(doc_id as varchar), '') || ':' || run)) as digits
    from runs group by doc_id, run
),
bits as (
    select run, places, flatten(list_transform(range(0, length(digits) // 2), lambda i: list_transform(range(0, 8),
        lambda j: ((instr('0123456789ABCDEF', substr(digits, cast(2 * i + if(j < 4, 2, 1) as bigint), 1)) - 1) >> cast(j % 4 as integer)) & 1))) as bits
    from told
),
hashed as (
    select run, places, xor(4294967295, list_reduce(list_prepend(cast(4294967295 as bigint), bits),
        lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1)))) as h
    from bits
),
words as (
    select word, cast(sum(places) as bigint) as n from (
        select if(h % 31 = 0, left(run, h % length(run)) || substr(run, h % length(run) + 2), run) as word, places from hashed
    ) where length(word) >= 7 group by word having sum(places) >= 2
),
skipped as (
    select distinct word, n, i, left(word, i) || chr(0) || substr(word, i + 2) as gap, left(word, i) || substr(word, i + 2) as short
    from (select word, n, unnest(range(0, length(word))) as i from words)
),
near as (
    select a.word, b.word as other, b.n from skipped a join skipped b on a.gap = b.gap and a.word <> b.word
    union
    select a.word, b.word, b.n from skipped a join words b on a.short = b.word
    union
    select b.word, a.word, a.n from skipped a join words b on a.short = b.word
),
best as (
    select word, count(*) as n_near, min({'less': -n, 'other': other}) as top from near group by word
),
formed as (
    select w.word, w.n, coalesce(b.n_near, 0) as n_near,
        if(-b.top.less >= 10 * w.n, b.top.other, null) as form, if(-b.top.less >= 10 * w.n, -b.top.less, null) as form_n
    from words w left join best b on b.word = w.word
),
ways as (
    select word, word as root, 0 as steps from formed
    union all
    select y.word, f.form, y.steps + 1 from ways y join formed f on f.word = y.root where f.form is not null
)
select f.word, f.form, y.root, f.n, f.n_near, f.form_n
from formed f join (select word, max_by(root, steps) as root from ways group by word) y on y.word = f.word
"""


@query
def op13_nearest_vectors(spark, sf_dir):
    return nearest_vectors(table(spark, sf_dir, "embeddings"))
