"""The named queries of this subpackage, one per operator, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tenorbook.llm import decontamination, language_id, mixing, ngram_join, prefix_trie, quality, quality_rules, repair, substring_dedup, suffix_dedup, token_counts, topk_search, warc
from tenorbook.llm.common import read

#: The vocabulary of the token counts.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(read(spark, folder, "documents"))


def op2_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.dedupe(read(spark, folder, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, folder, "documents"), token_counts.vocabulary(VOCABULARY))


def op4_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.join(read(spark, folder, "documents")).select("doc_id", "class_id", "n_links")


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    return language_id.identify(docs, language_id.profiles(docs))


def op6_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.dedupe(read(spark, folder, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op7_warc_derivatives(spark: SparkSession, folder: str) -> DataFrame:
    return warc.derive(warc.responses(read(spark, folder, "pages"))).withColumnRenamed("key", "page_id")


def op8_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    return topk_search.top_k(read(spark, folder, "embeddings"))


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contamination(read(spark, folder, "documents"), read(spark, folder, "benchmark")).drop("text_hash")


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(read(spark, folder, "documents"), read(spark, folder, "labels"))


def op11_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")
    return quality_rules.judge(read(spark, folder, "documents"), read(spark, folder, "labels")).select(*columns)


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = read(spark, folder, "conversations")
    return repair.repair(repair.damaged(rows), rows)


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.trie(*prefix_trie.rebuilt(prefix_trie.turns_of(read(spark, folder, "conversations"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_mixing, op2_suffix_dedup, op3_token_counts, op4_ngram_join, op5_language_id, op6_substring_dedup, op7_warc_derivatives, op8_topk_search,
        op9_decontamination, op10_quality, op11_quality_rules, op12_conversation_repair, op13_prefix_trie,
    )
}

def _crc32(text: str) -> str:
    """SQL for the CRC-32 of a short ASCII text, bit by bit."""
    bit = "list_reduce(list_prepend(xor(c, b), list_transform(range(8), lambda k: cast(0 as bigint))), lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))"
    codes = f"list_transform(string_split({text}, ''), lambda x: cast(ascii(x) as bigint))"
    return f"xor(4294967295, list_reduce(list_prepend(cast(4294967295 as bigint), {codes}), lambda c, b: {bit}))"


SQL = {
    "op2_suffix_dedup": """
with d as (select row_number() over () as rid, doc_id, encode(coalesce(text, '')) as raw from documents),
windows as (select rid, s, md5(raw[s:s + 399]) as h from d, unnest(range(1, octet_length(raw) - 398)) as t(s)),
many as (select h from windows group by h having count(*) > 1),
starts as (select rid, s, s - lag(s) over (partition by rid order by s) as step from windows semi join many using (h)),
islands as (select rid, s, sum(if(step <= 400, 0, 1)) over (partition by rid order by s) as island from starts),
runs as (select rid, min(s) as b, max(s) + 399 as e from islands group by rid, island),
behind as (select *, coalesce(lag(e) over (partition by rid order by b), 0) as last from runs),
gone as (select rid, count(*) as n_spans, sum(e - b + 1) as n_removed, string_agg(hex(raw[last + 1:b - 1]), '' order by b) as kept, max(e) as upto
  from behind join d using (rid) group by rid)
select doc_id, cast(octet_length(raw) as bigint) as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed, coalesce(n_spans, 0) as n_spans,
  sha256(unhex(coalesce(kept, '') || hex(raw[coalesce(upto, 0) + 1:octet_length(raw)]))) as kept_sha256
from d left join gone using (rid)""",
    "op4_ngram_join": r"""
with recursive d as (select row_number() over () as rid, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
shingle as (select distinct rid, array_to_string(w[s:s + least(5, len(w)) - 1], ' ') as g from d, unnest(range(1, len(w) - least(5, len(w)) + 2)) as t(s) where len(w) > 0),
sizes as (select rid, count(*) as n from shingle group by rid),
common as (select a.rid as a, b.rid as b, count(*) as c from shingle a join shingle b on a.g = b.g and a.rid < b.rid group by all),
links as (select a, b from common join sizes x on x.rid = a join sizes y on y.rid = b where 5 * c >= 4 * (x.n + y.n - c)),
ties as (select a, b from links union all select b, a from links),
reach(rid, other) as (select rid, rid from d union select r.rid, b from reach r join ties on a = r.other),
class as (select reach.rid, min(doc_id) as class_id from reach join d on d.rid = reach.other group by reach.rid),
counts as (select a as rid, count(*) as n_links from ties group by a)
select doc_id, class_id, coalesce(n_links, 0) as n_links from d join class using (rid) left join counts using (rid)""",
    "op6_substring_dedup": r"""
with d as (select row_number() over () as rid, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
windows as (select rid, s, md5(array_to_string(w[s:s + 34], ' ')) as h from d, unnest(range(1, len(w) - 33)) as t(s)),
many as (select h from windows group by h having count(*) > 1),
gone as (select distinct rid, i from windows join many using (h), unnest(range(s, s + 35)) as t(i)),
flat as (select rid, i, w[i] as x from d, unnest(range(1, len(w) + 1)) as t(i)),
kept as (select rid, string_agg(x, ' ' order by i) as text, count(*) as n from flat anti join gone using (rid, i) group by rid)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(len(w) - coalesce(n, 0) as bigint) as n_removed, sha256(coalesce(text, '')) as kept_sha256
from d left join kept using (rid)""",
    "op8_topk_search": r"""
with v as (select row_number() over () as rid, vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as e from embeddings
  where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pairs as (select q.rid as qid, q.vec_id as query_id, c.vec_id, c.rid, cast(list_dot_product(q.e, c.e) as bigint) as score
  from v q join v c on q.rid <> c.rid and len(q.e) = len(c.e) where q.vec_id % 50 = 0),
ranked as (select *, row_number() over (partition by qid order by score desc, vec_id nulls last, rid) as k from pairs)
select query_id, cast(k as integer) as rank, vec_id, score from ranked where k <= 5""",
    "op9_decontamination": r"""
with d as (select row_number() over () as rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select row_number() over () as iid, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
test as (select distinct iid, n, array_to_string(w[s:s + n - 1], ' ') as p from (select iid, w, least(13, len(w)) as n from b where len(w) > 0), unnest(range(1, len(w) - n + 2)) as t(s)),
sizes as (select distinct n from test),
hits as (select rid, s, sizes.n, iid from d, sizes, unnest(range(1, len(w) - sizes.n + 2)) as t(s) join test on test.n = sizes.n and test.p = array_to_string(w[s:s + sizes.n - 1], ' ')),
words as (select rid, count(distinct i) as n_hit from hits, unnest(range(s, s + n)) as t(i) group by rid),
items as (select rid, count(*) as n_items, string_agg(id, ',' order by id) as ids from (select distinct rid, iid, cast(item_id as varchar) as id from hits join b using (iid)) group by rid)
select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join words using (rid) left join items using (rid)""",
    "op12_conversation_repair": rf"""
with recursive hashed as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
  {_crc32("coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ')")} % 20 as f from conversations),
hurt as (select conv_id, turn, case f when 4 then 'user' else role end as role,
  case f when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
  from hashed, unnest(range(case f when 0 then 0 when 3 then 2 else 1 end)) as t(k)),
numbered as (select *, row_number() over (partition by conv_id, role, text order by i) as again, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) as final
  from (select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i from hurt)),
marked as (select *, left(role, 1) as r, case when final = '' then 'b' when again > 1 then 'd' when final not in ('.', '!', '?') then 't' else 'n' end as f from numbered),
step(q, letter, q2, name) as (values (0, 's', 1, null), (0, 'u', 2, 'user'), (1, 'u', 2, 'user'), (2, 'a', 3, 'assistant'), (3, 'u', 2, 'user')),
before(q, q2, cost, audit, names) as (select q, q, 0, '', cast([] as varchar[]) from range(4) as t(q)
  union all select q, q2, 2, 'I', [name || ':'] from step where name is not null
  union all select a.q, b.q2, 4, 'II', [a.name || ':', b.name || ':'] from step a join step b on b.q = a.q2 where a.name is not null and b.name is not null),
edit as (select conv_id, i, q, q as q2, 3 as cost, 'D' as audit, cast([] as varchar[]) as names from marked, range(4) as t(q)
  union all select conv_id, i, q, q2, if(f = 't', 1, 0), 'K', [role || ':' || text] from marked join step on letter = r where f in ('t', 'n')
  union all select conv_id, i, q, q2, if(f = 't', 3, 2), 'R', [name || ':' || text] from marked join step on name is not null where f in ('t', 'n')),
moves as (select e.conv_id, i, b.q, e.q2, b.cost + e.cost as cost, b.audit || e.audit as audit, list_concat(b.names, e.names) as names from edit e join before b on b.q2 = e.q),
way(conv_id, i, q, cost, audit, names) as (
  select distinct conv_id, cast(0 as bigint), 0, cast(0 as bigint), '', cast([] as varchar[]) from marked
  union all select conv_id, i, q2, cost, audit, names from (select w.conv_id, m.i, m.q2, w.cost + m.cost as cost, w.audit || m.audit as audit, list_concat(w.names, m.names) as names,
    row_number() over (partition by w.conv_id, m.q2 order by w.cost + m.cost, w.audit || m.audit) as k
    from way w join moves m on m.conv_id is not distinct from w.conv_id and m.i = w.i + 1 and m.q = w.q) where k = 1),
ended as (select w.conv_id, w.cost + b.cost as cost, w.audit || b.audit as audit, list_concat(w.names, b.names) as names
  from way w join (select conv_id, count(*) as n from marked group by conv_id) c on c.conv_id is not distinct from w.conv_id and c.n = w.i join before b on b.q = w.q and b.q2 in (0, 3)),
best as (select * from ended qualify row_number() over (partition by conv_id order by cost, audit) = 1),
pairs as (select conv_id, lag(r) over (partition by conv_id order by i) || r as p from marked),
bad as (select conv_id, count(*) as n from pairs where p not in ('su', 'ua', 'au') group by conv_id),
counts as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (f = 'b') as blank, count(*) filter (f = 'd') as duplicate,
  count(*) filter (f = 't') as truncated from marked group by conv_id)
select o.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
  coalesce(n, 0) as illegal, coalesce(cost, 0) as cost, coalesce(audit, '') as audit, sha256(coalesce(array_to_string(names, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) o left join counts c on c.conv_id is not distinct from o.conv_id
left join bad d on d.conv_id is not distinct from o.conv_id left join best b on b.conv_id is not distinct from o.conv_id""",
    "op13_prefix_trie": rf"""
with t as (select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, turn from conversations where conv_id is not null),
kept as (select conv_id, list(length(role) || ':' || role || text order by turn nulls first, sha256(length(role) || ':' || role || text)) as w,
  list(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) order by turn nulls first, sha256(length(role) || ':' || role || text)) as n from t group by conv_id),
h as (select *, conv_id - conv_id % 20 as base, {_crc32("cast(conv_id as varchar)")} % 4 as h from kept),
built as (select a.conv_id, list_concat(coalesce(b.w, [])[1:a.h], a.w[a.h + 1:]) as w, list_concat(coalesce(b.n, [])[1:a.h], a.n[a.h + 1:]) as n from h a left join kept b on b.conv_id = a.base),
node as (select w[1:d] as p, d as depth, min(conv_id) as conv_id, count(*) as n_convs, coalesce(any_value(n[d]), 0) as words,
  coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (len(w) = d), '') as ends from built, unnest(range(len(w) + 1)) as t(d) group by w[1:d], d),
kids as (select p[1:depth - 1] as p, depth - 1 as depth, count(*) as n_children from node where depth > 0 group by all),
full_node as (select node.*, coalesce(n_children, 0) as n_children from node left join kids using (p, depth)),
sums as (select p[1:d] as p, d as depth, sum(if(n_children = 0, 1, 0)) as n_leaves, sum((n_convs - 1) * words) as saved from full_node, unnest(range(depth + 1)) as t(d) group by p[1:d], d)
select a.conv_id, a.depth, b.conv_id as parent_conv_id, a.n_convs, a.n_children, cast(n_leaves as bigint) as n_leaves, cast(saved as bigint) as saved_tokens, sha256(a.ends) as ends_sha256
from full_node a join sums using (p, depth) left join node b on b.depth = a.depth - 1 and b.p = a.p[1:a.depth - 1]""",
}
