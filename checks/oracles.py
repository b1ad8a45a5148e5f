"""The same results in plain SQL, for DuckDB on the same tables."""

from __future__ import annotations

from checks import fixtures as fx
from docspark.functions import text as tx
from docspark.params import NA_TOKENS, SEARCH_SECTIONS

# White space as a character class of DuckDB's regex dialect.
WS = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
NOT_WS = WS.replace("[", "[^", 1)
WIDE_SECTIONS = ("section_1", "section_1A", "section_2", "section_7", "section_8", "section_10")

_NA = ", ".join(f"'{token}'" for token in NA_TOKENS)


def _present(column: str) -> str:
    return f"case when {column} not in ({_NA}) then {column} end as {column}"


def _has_text(column: str) -> str:
    return f"coalesce(not regexp_full_match({column}, '{WS}*'), false)"


SEGMENTS = f"segments as ({fx.SEGMENTS})"
RAW = f"{SEGMENTS}, raw as ({fx.FILINGS_RAW})"
WIDE = (
    f"{SEGMENTS}, wide_in as ({fx.FILINGS_WIDE}), wide as (select filename, cik, year, "
    + ", ".join(_present(s) for s in WIDE_SECTIONS)
    + " from wide_in)"
)
ITEMS = f"asked_items as ({fx.ITEMS})"

# DuckDB has no lookahead: flag header lines, number the sections, glue the lines again.
_HEADER = rf"(?i)(ITEM{WS}+\d+[A-Z]?\.?|PART{WS}+[IVXLCDM]+){WS}*"


def _sections(keep_last: bool = False) -> str:
    last = "" if keep_last else "s < last_s and "
    return f"""
lines as (select doc_id, unnest(string_split(text, chr(10))) as line,
                 generate_subscripts(string_split(text, chr(10)), 1) as n from raw),
flagged as (select *, regexp_full_match(line, '{_HEADER}') as is_header from lines),
numbered as (select *, sum(is_header::int) over (partition by doc_id order by n) as s
             from flagged),
glued as (
  select doc_id, s,
         max(case when is_header then upper(trim(
           regexp_replace(regexp_replace(line, '^{WS}+|{WS}+$', '', 'g'), '{WS}+', ' ', 'g'),
           '.')) end) as section_title,
         regexp_replace(
           coalesce(string_agg(line, chr(10) order by n) filter (where not is_header), ''),
           '^{WS}+|{WS}+$', '', 'g') as section_text,
         max(max(s)) over (partition by doc_id) as last_s
  from numbered group by doc_id, s),
sections as (
  select doc_id, section_title, section_text from glued where {last} s > 0
  qualify row_number() over (partition by doc_id, section_title order by s desc) = 1)"""


def _windows(source: str, keys: str, text: str, size: int, overlap: int = 0) -> str:
    """Chunks of ``text`` as (keys, chunk_index, chunk)."""
    step = size - overlap
    return f"""
select {keys}, i as chunk_index,
       array_to_string(words[i * {step} + 1 : i * {step} + {size}], ' ') as chunk
from (select {keys}, words, unnest(range((len(words) + {step - 1}) // {step})) as i
      from (select {keys}, regexp_extract_all({text}, '{NOT_WS}+') as words from {source}))"""


def _literal(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


# DuckDB has no lookbehind: a sentence ends between two words that look like it.
_GAP = f"""regexp_matches(word, {_literal(tx.SENTENCE_END + "$")})
  and not regexp_matches(word, {_literal(r"(?:^|[^\p{L}\p{Nd}.])" + tx.ABBREVIATED + "$")})
  and regexp_matches(next_word, {_literal("^" + tx.SENTENCE_START)})"""


def _split_sentences(name: str, source: str) -> str:
    """``name`` as (doc_id, par, nth, sentence): the sentences of paragraphs (doc_id, par, text)."""
    return f"""
{name}_words as (
  select doc_id, par, i, words[i] as word, words[i + 1] as next_word
  from (select doc_id, par, words, unnest(range(1, len(words) + 1)) as i
        from (select doc_id, par, regexp_extract_all(text, '{NOT_WS}+') as words from {source}))),
{name}_ends as (
  select *, coalesce(sum(case when {_GAP} then 1 else 0 end) over (
    partition by doc_id, par order by i rows between unbounded preceding and 1 preceding), 0) as nth
  from {name}_words),
{name} as (select doc_id, par, nth, string_agg(word, ' ' order by i) as sentence
           from {name}_ends group by all)"""


def _cut_long(name: str, source: str, size: int) -> str:
    """``name`` as (doc_id, nth, piece, n): pieces in order, long ones in windows of ``size`` words."""
    return f"""
{name}_windows as (
  select doc_id, par, nth, i, array_to_string(words[i * {size} + 1 : i * {size} + {size}], ' ') as piece
  from (select doc_id, par, nth, words, unnest(range((len(words) + {size - 1}) // {size})) as i
        from (select doc_id, par, nth, string_split(sentence, ' ') as words from {source}))),
{name} as (select doc_id, row_number() over (partition by doc_id order by par, nth, i) as nth, piece,
                  len(string_split(piece, ' ')) as n from {name}_windows)"""


def _filled(name: str, source: str, size: int) -> str:
    """``name`` as (doc_id, chunk_index, chunk): neighbours of ``topic`` merged greedily."""
    return f"""
{name}_fold as (
  select doc_id, nth, n as held, topic, 0 as pos from {source} where nth = 1
  union all
  select p.doc_id, p.nth,
         case when p.topic <> f.topic or f.held + p.n > {size} then p.n else f.held + p.n end,
         p.topic, case when p.topic <> f.topic or f.held + p.n > {size} then f.pos + 1 else f.pos end
  from {name}_fold f join {source} p on p.doc_id = f.doc_id and p.nth = f.nth + 1),
{name} as (select doc_id, cast(pos as int) as chunk_index, string_agg(piece, ' ' order by nth) as chunk
           from {name}_fold join {source} using (doc_id, nth) group by doc_id, pos)"""


WHOLE = "paragraphs as (select doc_id, 1 as par, text from documents)"
LINES = """paragraphs as (
  select doc_id, par, text
  from (select doc_id, unnest(string_split(text, chr(10))) as text,
               generate_subscripts(string_split(text, chr(10)), 1) as par from documents))"""


def _recursive(size: int, overlap: int) -> str:
    own = size - overlap
    counted = f"len(regexp_extract_all(text, '{NOT_WS}+'))"
    return f"""with recursive {LINES},
short as (select doc_id, par, 0 as nth, trim(regexp_replace(text, '{WS}+', ' ', 'g')) as sentence
          from paragraphs where {counted} between 1 and {own}),
tall as (select * from paragraphs where {counted} > {own}),
{_split_sentences("long_ones", "tall")},
both_kinds as (select * from short union all select * from long_ones),
{_cut_long("pieces", "both_kinds", own)},
ordered as (select *, 0 as topic from pieces),
{_filled("chunks", "ordered", own)},
words as (select doc_id, chunk_index, chunk, string_split(chunk, ' ') as ws from chunks)
select doc_id, chunk_index,
       case when chunk_index = 0 then chunk else array_to_string(
         lag(ws[greatest(1, len(ws) - {overlap - 1}) :]) over (partition by doc_id order by chunk_index), ' ')
         || ' ' || chunk end as chunk_text
from words"""


LONG = "long as (" + " union all ".join(
    f"select filename, cik, year, '{s}' as section, {i} as section_pos, {s} as text from wide"
    for i, s in enumerate(SEARCH_SECTIONS)
) + ")"


def _wide_chunks(size: int = 500) -> str:
    windows = _windows("long", "filename, cik, year, section, section_pos", "text", size)
    return f"""{WIDE}, {LONG}, chunks as (
  select chunk as text, year, cik, filename, section, section_pos,
         cast(chunk_index as int) as chunk_index,
         concat(filename, '_', section, '_', chunk_index) as chunk_id
  from ({windows}))"""


def _embed(name: str, source: str, key: str, text: str) -> str:
    """``name`` as (key, bucket, weight): hashed word counts of unit length in FLOAT."""
    return f"""
{name}_counts as (
  select {key}, bucket, count(*) as c
  from (select {key}, ('0x' || substr(md5(word), 1, 6))::int % 64 as bucket
        from (select {key}, unnest(string_split(lower({text}), ' ')) as word from {source}))
  group by {key}, bucket),
{name} as (
  select {key}, bucket,
         cast(cast(c / sqrt(sum(c * c) over (partition by {key})) as float) as double) as weight
  from {name}_counts)"""


def _hits(k: int, questions: str) -> str:
    """Search hits of ``questions`` (query_id, query, year) over all chunks of the year."""
    plain = (
        f"plain as (select query_id, trim(regexp_replace(query, '{WS}+', ' ', 'g')) as query "
        f"from {questions})"
    )
    return f"""{plain},
{_embed("chunk_vec", "chunks", "chunk_id", "text")},
{_embed("query_vec", "plain", "query_id", "query")},
chunk_norm as (select chunk_id, sqrt(sum(weight * weight)) as n from chunk_vec group by 1),
query_norm as (select query_id, sqrt(sum(weight * weight)) as n from query_vec group by 1),
dots as (select query_id, chunk_id, sum(q.weight * c.weight) as dot
         from query_vec q join chunk_vec c using (bucket) group by 1, 2),
scored as (
  select q.query_id, c.*, round(coalesce(d.dot, 0) / (qn.n * cn.n), 9) as score
  from {questions} q join chunks c using (year)
  join query_norm qn using (query_id) join chunk_norm cn using (chunk_id)
  left join dots d on d.query_id = q.query_id and d.chunk_id = c.chunk_id),
hits as (
  select query_id,
         cast(row_number() over (partition by query_id order by score desc, filename,
                                 section_pos, chunk_index) as int) as rank,
         concat(substring(text, 1, 200), '...') as chunk, text as full_text,
         year, cik, filename, section, chunk_id, round(score, 6) as similarity_score
  from scored qualify rank <= {k})"""


QUESTIONS = "questions as (select item_id as query_id, query, year from {source})"
PLAIN = f"""plain as (select query_id, trim(regexp_replace(query, '{WS}+', ' ', 'g')) as query
          from questions)"""


def _keyword_hits(k: int) -> str:
    """``kw_hits``: BM25 of ``plain`` questions over all chunks of the year, statistics over all."""
    return f"""
kw_chunk as (select *, string_split(lower(text), ' ') as ws from chunks),
kw_tf as (select chunk_id, word, count(*) as tf
          from (select chunk_id, unnest(ws) as word from kw_chunk) group by 1, 2),
kw_df as (select word, count(*) as df from kw_tf group by 1),
kw_all as (select count(*) as n, avg(len(ws)) as average from kw_chunk),
kw_asked as (select query_id, word, count(*) as qtf
             from (select query_id, unnest(string_split(lower(query), ' ')) as word from plain)
             where word <> '' group by 1, 2),
kw_scored as (
  select a.query_id, c.chunk_id,
         round(sum(qtf * ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2
                   / (tf + 1.2 * (0.25 + 0.75 * len(c.ws) / average))), 9) as score
  from kw_asked a join kw_df using (word) join kw_tf using (word)
  join kw_chunk c using (chunk_id) join questions q on q.query_id = a.query_id and q.year = c.year, kw_all
  group by 1, 2),
kw_hits as (
  select s.query_id,
         cast(row_number() over (partition by s.query_id order by score desc, filename,
                                 section_pos, chunk_index) as int) as rank,
         concat(substring(text, 1, 200), '...') as chunk, text as full_text,
         year, cik, filename, section, chunk_id, round(score, 6) as similarity_score,
         score as exact_score
  from kw_scored s join chunks using (chunk_id) qualify rank <= {k})"""


def _fused(vector_gain: str, keyword_gain: str, k: int) -> str:
    """Both lists of twenty hits fused by their gains."""
    columns = "chunk, full_text, year, cik, filename, section"
    return f"""with {_wide_chunks()}, {ITEMS}, {QUESTIONS.format(source="asked_items")},
{_hits(20, "questions")}, {_keyword_hits(20)},
vector_hits as (select h.*, s.score as exact_score
                from hits h join scored s using (query_id, chunk_id)),
gains as (
  select query_id, chunk_id, {columns}, {vector_gain} as gain from vector_hits
  union all select query_id, chunk_id, {columns}, {keyword_gain} from kw_hits),
fused as (select query_id, chunk_id, {", ".join(f"any_value({c}) as {c}" for c in columns.split(", "))},
                 round(sum(gain), 9) as score from gains group by 1, 2)
select query_id,
       cast(row_number() over (partition by query_id order by score desc, chunk_id) as int) as rank,
       {columns}, chunk_id, round(score, 6) as similarity_score
from fused qualify rank <= {k}"""


def _scaled(weight: float) -> str:
    own = "over (partition by query_id)"
    low, high = f"min(exact_score) {own}", f"max(exact_score) {own}"
    return f"{weight}::double * case when {high} = {low} then 1 else (exact_score - {low}) / ({high} - {low}) end"


FIRST = """first_filing as (
  select * from wide
  qualify row_number() over (partition by year order by filename) = 1)"""
KEPT = "kept as (" + " union all ".join(
    f"select i.item_id, i.query, i.expected_section, i.expected_answer, i.year, f.cik "
    f"from asked_items i join first_filing f using (year) "
    f"where i.expected_section = '{s}' and f.{s} is not null"
    for s in ("section_8", "section_10")
) + ")"
CHECKED = f"""with {_wide_chunks()}, {ITEMS}, {FIRST}, {KEPT},
{QUESTIONS.format(source="kept")}, {_hits(3, "questions")},
checked as (
  select k.item_id,
         coalesce(min(h.rank) filter (contains(lower(h.full_text), lower(k.expected_answer))) = 1,
                  false) as hit_at_1,
         min(h.rank) filter (contains(lower(h.full_text), lower(k.expected_answer))) as hit_rank,
         count(h.rank) as n_hits
  from kept k left join hits h on h.query_id = k.item_id group by k.item_id)"""

# Embeddings as (vec_id, label, dim, x), label means, distances to them.
CELLS = """cells as (
  select vec_id, label, unnest(range(len(embedding))) as dim,
         cast(unnest(embedding) as double) as x from embeddings)"""
CENTERS = f"""{CELLS}, centers as (
  select label, dim, avg(x) as m from cells group by label, dim)"""
DISTANCES = f"""{CENTERS}, distances as (
  select vec_id, label as prediction,
         cast(sqrt(sum((x - m) * (x - m))) as float) as distance_to_center
  from cells join centers using (label, dim) group by vec_id, label),
stats as (
  select prediction, avg(cast(distance_to_center as double)) as mean_dist,
         stddev_samp(cast(distance_to_center as double)) as std_dist
  from distances group by prediction),
flagged as (
  select *, distance_to_center > mean_dist + 2 * std_dist as is_outlier
  from distances join stats using (prediction))"""
POINTS = f"""{DISTANCES}, points as (
  select cast(e.embedding[1] as double) as x, cast(e.embedding[2] as double) as y,
         f.prediction as cluster, coalesce(f.is_outlier, false) as outlier,
         d.lang as section, d.source as company
  from flagged f join embeddings e using (vec_id) left join documents d on d.doc_id = f.vec_id)"""


def _bins(by: str) -> str:
    return f"""with {POINTS}
select round(floor(x / 0.05) * 0.05, 6) + 0.0 as x, round(floor(y / 0.05) * 0.05, 6) + 0.0 as y,
       {by}, count(*) as n_points
from points group by floor(x / 0.05) * 0.05, floor(y / 0.05) * 0.05, {by}"""


def _topk(scope: str, where: str = "true") -> str:
    return f"""with {CENTERS},
scored as (
  select q.label as query_id, c.vec_id, c.label,
         round(sum(c.x * q.m) / sqrt(sum(c.x * c.x) * sum(q.m * q.m)), 9) as score
  from centers q join cells c on c.dim = q.dim {scope}
  where {where} group by 1, 2, 3)
select query_id,
       cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank,
       vec_id, label, round(score, 6) + 0.0 as similarity_score
from scored qualify rank <= 5"""


ORACLES: dict[str, str] = {
    "select_companies": f"""with {RAW} select * from raw
where cik in (select distinct cik from raw order by cik limit 5)""",
    "select_company_list": f"with {RAW} select * from raw where cik in ('src3', 'src12', 'none')",
    "filter_cik_years": f"with {WIDE} select * from wide where cik = 'src3' and year in (2018, 2020)",
    "filter_year": f"with {RAW} select * from raw where year = 2020",
    "first_per_year": f"with {WIDE}, {FIRST} select * from first_filing",
    "corpus_shape": f"""with {WIDE}
select count(*) as n_filings, cast(9 as int) as n_columns, count(distinct year) as n_years,
       count(distinct cik) as n_companies, min(year) as first_year, max(year) as last_year
from wide""",
    "corpus_values": f"""with {WIDE}
select 'year' as attribute, cast(year as varchar) as value, count(*) as n_filings
from wide group by year
union all select 'cik', cik, count(*) from wide group by cik""",
    "section_profile": f"""with {WIDE}
select filename, year, cik,
       cast({" + ".join(f"{_has_text(s)}::int" for s in WIDE_SECTIONS)} as int) as n_sections,
       cast({" + ".join(f"case when {_has_text(s)} then length({s}) else 0 end"
                        for s in WIDE_SECTIONS)} as bigint) as n_chars,
       concat_ws(', ', {", ".join(
           f"case when {_has_text(s)} then format('{s} ({{:,}} chars)', length({s})) end"
           for s in WIDE_SECTIONS)}) as sections
from wide""",
    "csv_round_trip": f"with {WIDE} select * from wide",
    "table_round_trip": f"""with {WIDE}
select filename, cik, year, section_1, section_1A, section_7, cast(null as varchar) as section_15
from wide where year in (2019, 2020)""",
    "scan_raw": f"""with {RAW}
select cik, company_name, filing_type, year, text from raw where year = 2020 and doc_id % 3 <> 0""",
    "scan_wide_extra_sections": f"""with {SEGMENTS}, wide_in as ({fx.FILINGS_WIDE})
select filename, cik, cast(year as int) as year, section_2, upper(section_2) as section_9C,
       cast(length(section_1) as varchar) as section_16, cast(null as varchar) as section_15
from wide_in where cik = 'src3' and year in (2018, 2020)""",
    "csv_many_files": f"""with {WIDE}
select filename, cik, year, case when year = 2020 then section_2 end as section_2, section_8
from wide""",
    "years_sorted": f"""with {WIDE}
select cast(row_number() over (order by year) as int) as place, year
from (select distinct year from wide)""",
    "embed_pandas": """
select doc_id, cast(case when doc_id % 7 <> 0 then length(text) end as double) as n,
       cast(case when doc_id % 7 <> 0 then length(text) - length(replace(text, ' ', '')) end
            as double) as blanks,
       case when doc_id % 7 <> 0 then cast(1 as double) end as one from documents""",
    "pca_correlation": """
select cast(i as int) as i, cast(j as int) as j,
       case when i = j then cast(1 as double) else cast(0 as double) end as correlation,
       true as falls
from range(8) a(i), range(8) b(j)""",
    "kmeans_nearest": """
select count(*) as n_rows, 0 as n_not_nearest, count(distinct vec_id) as n_members
from embeddings""",
    "bm25_search": f"""with {_wide_chunks()}, {ITEMS}, {QUESTIONS.format(source="asked_items")},
{PLAIN}, {_keyword_hits(5)} select * exclude (exact_score) from kw_hits""",
    "hybrid_search": _fused("1.0::double / (60 + rank)", "1.0::double / (60 + rank)", 5),
    "hybrid_search_weighted": _fused(_scaled(0.7), _scaled(0.3), 5),
    "search_expanded": f"""with {_wide_chunks()}, {ITEMS}, {QUESTIONS.format(source="asked_items")}, {PLAIN},
bench as (select string_split(lower(text), ' ') as ws from benchmark),
synonyms as (
  select word, synonym, max(weight) as weight
  from (select ws[1] as word, ws[2] as synonym, 0.9::double as weight from bench
        union all select ws[1], ws[3], 0.5::double from bench)
  where synonym is not null group by 1, 2),
asked as (select query_id, ws, unnest(range(1, len(ws) + 1)) as i
          from (select query_id, string_split(query, ' ') as ws from plain)),
worded as (
  select query_id, query, 1.0::double as weight from plain
  union all
  select query_id, array_to_string(list_concat(ws[1 : i - 1], [synonym], ws[i + 1 :]), ' '), weight
  from asked join synonyms on lower(ws[i]) = word),
wordings as (select query_id, query, max(weight) as weight, query_id || '_' || query as wording
             from worded group by 1, 2),
{_embed("chunk_vec", "chunks", "chunk_id", "text")},
{_embed("query_vec", "wordings", "wording", "query")},
chunk_norm as (select chunk_id, sqrt(sum(weight * weight)) as n from chunk_vec group by 1),
query_norm as (select wording, sqrt(sum(weight * weight)) as n from query_vec group by 1),
dots as (select wording, chunk_id, sum(q.weight * c.weight) as dot
         from query_vec q join chunk_vec c using (bucket) group by 1, 2),
scored as (
  select q.query_id, c.chunk_id,
         max(round(w.weight * round(coalesce(d.dot, 0) / (qn.n * cn.n), 9), 9)) as score
  from questions q join wordings w using (query_id) join chunks c on c.year = q.year
  join query_norm qn using (wording) join chunk_norm cn on cn.chunk_id = c.chunk_id
  left join dots d on d.wording = w.wording and d.chunk_id = c.chunk_id group by 1, 2)
select query_id,
       cast(row_number() over (partition by query_id order by score desc, filename,
                               section_pos, chunk_index) as int) as rank,
       concat(substring(text, 1, 200), '...') as chunk, text as full_text,
       year, cik, filename, section, chunk_id, round(score, 6) as similarity_score
from scored join chunks using (chunk_id) qualify rank <= 5""",
    "search_reranked": f"""with {_wide_chunks()}, {ITEMS}, {QUESTIONS.format(source="asked_items")},
{_hits(20, "questions")},
again as (
  select h.*, round(len(list_intersect(q, t)) / len(q), 9) as score
  from (select h.* exclude (similarity_score),
               list_distinct(regexp_extract_all(lower(p.query), '{NOT_WS}+')) as q,
               list_distinct(regexp_extract_all(lower(full_text), '{NOT_WS}+')) as t
        from hits h join plain p using (query_id)) h)
select query_id, cast(row_number() over (partition by query_id order by score desc, rank) as int) as rank,
       chunk, full_text, year, cik, filename, section, chunk_id, round(score, 6) as similarity_score
from again qualify row_number() over (partition by query_id order by score desc, rank) <= 5""",
    "search_empty_year": f"""with {_wide_chunks()}, {ITEMS},
{QUESTIONS.format(source="asked_items")}, {_hits(5, "questions")} select * from hits where false""",
    "ask_one": f"""with {_wide_chunks()},
questions as (select 1 as query_id, 'The and of with' as query, 2020 as year),
{_hits(5, "questions")} select * from hits""",
    "retrieval_job": f"{CHECKED} select * from checked",
    "stage_counts": f"""with {RAW}, {_sections()},
chunks as ({_windows("sections", "doc_id, section_title", "section_text", 500)})
select 'filings' as stage, count(*) as n_rows from raw
union all select 'sections', count(*) from sections
union all select 'chunks', count(*) from chunks""",
    "sections": f"with {RAW}, {_sections()} select * from sections",
    "sections_keep_last": f"with {RAW}, {_sections(keep_last=True)} select * from sections",
    "chunk_words": f"""select doc_id, cast(chunk_index as int) as chunk_index, chunk as chunk_text
from ({_windows("documents", "doc_id", "text", 50)})""",
    "chunk_overlap": f"""select doc_id, cast(chunk_index as int) as chunk_index, chunk as chunk_text
from ({_windows("documents", "doc_id", "text", 50, 10)})""",
    "chunk_sentences": f"""with recursive {WHOLE}, {_split_sentences("found", "paragraphs")},
{_cut_long("pieces", "found", 60)}, ordered as (select *, 0 as topic from pieces),
{_filled("chunks", "ordered", 60)}
select doc_id, chunk_index, chunk as chunk_text from chunks""",
    "chunk_recursive": _recursive(60, 10),
    "chunk_semantic": f"""with recursive {WHOLE}, {_split_sentences("found", "paragraphs")},
{_cut_long("pieces", "found", 60)},
keyed as (select *, doc_id || '_' || nth as piece_id from pieces),
{_embed("vec", "keyed", "piece_id", "piece")},
norms as (select piece_id, sqrt(sum(weight * weight)) as norm from vec group by 1),
dots as (select a.piece_id, sum(x.weight * y.weight) as dot
         from keyed a join keyed b on b.doc_id = a.doc_id and b.nth = a.nth + 1
         join vec x on x.piece_id = a.piece_id join vec y on y.piece_id = b.piece_id and y.bucket = x.bucket
         group by 1),
apart as (select b.doc_id, b.nth, round(1 - coalesce(dot, 0) / (x.norm * y.norm), 9) + 0.0 as distance
          from keyed a join keyed b on b.doc_id = a.doc_id and b.nth = a.nth + 1
          join norms x on x.piece_id = a.piece_id join norms y on y.piece_id = b.piece_id
          left join dots d on d.piece_id = a.piece_id),
limits as (select doc_id, round(quantile_cont(distance, 0.9), 9) as top from apart group by 1),
ordered as (
  select k.doc_id, k.nth, piece, n,
         sum(coalesce(distance > top, false)::int) over (partition by k.doc_id order by k.nth) as topic
  from keyed k left join apart a on a.doc_id = k.doc_id and a.nth = k.nth left join limits l on l.doc_id = k.doc_id),
{_filled("chunks", "ordered", 60)}
select doc_id, chunk_index, chunk as chunk_text from chunks""",
    "chunk_raw": f"""with {RAW}, {_sections()},
chunks as ({_windows("sections", "doc_id, section_title", "section_text", 500)})
select cik, company_name, filing_type, year, section_title, chunk as chunk_text,
       cast(chunk_index as int) as chunk_index
from chunks join raw using (doc_id)""",
    "chunk_wide": f"with {_wide_chunks()} select * from chunks",
    "chunk_metadata": f"with {_wide_chunks(200)} select * exclude (text) from chunks",
    "embed_chunks": f"""with {_wide_chunks()}, {_embed("vec", "chunks", "chunk_id", "text")}
select chunk_id, bucket, round(weight, 6) as weight from vec""",
    "embed_shape": f"""with {_wide_chunks()}
select count(*) as n_vectors, cast(64 as int) as dim from chunks""",
    "embed_questions": f"""with {ITEMS},
plain as (select item_id as query_id, trim(regexp_replace(query, '{WS}+', ' ', 'g')) as query
          from asked_items),
{_embed("vec", "plain", "query_id", "query")}
select query_id, bucket, round(weight, 6) as weight from vec""",
    "scale": f"""with {CELLS}
select vec_id, cast(dim as int) as dim,
       round(x / stddev_samp(x) over (partition by dim), 6) + 0.0 as value from cells""",
    "pca_lengths": f"""with {CELLS},
scaled as (select vec_id, x / stddev_samp(x) over (partition by dim) as x from cells)
select vec_id, round(sqrt(sum(x * x)), 6) as length from scaled group by vec_id""",
    "explore_counts": f"""with {RAW}, {_sections()},
chosen as (select * from raw
           where cik in (select distinct cik from raw order by cik limit 5)),
chunks as ({_windows("(select * from sections semi join chosen using (doc_id))",
                     "doc_id, section_title", "section_text", 500)})
select 'filings' as stage, count(*) as n_rows from chosen
union all select 'chunks', count(*) from chunks
union all select 'embedded', count(*) from chunks
union all select 'clustered', count(*) from chunks""",
    "choose_k": """with points as (
  select vec_id, cast(embedding as double[]) as e, label % k as cluster, k
  from embeddings, (values (2), (3), (5), (10)) as ks(k)),
sizes as (select k, cluster, count(*) as n from points group by 1, 2),
apart as (
  select a.k, a.vec_id, a.cluster, b.cluster as other, sum(list_distance(a.e, b.e) ** 2) as total
  from points a join points b on a.k = b.k group by 1, 2, 3, 4),
means as (
  select a.k, vec_id, a.cluster,
         max(case when other = a.cluster then total / nullif(own.n - 1, 0) end) as inside,
         min(case when other <> a.cluster then total / s.n end) as near
  from apart a join sizes s on s.k = a.k and s.cluster = other
  join sizes own on own.k = a.k and own.cluster = a.cluster group by 1, 2, 3),
counts as (select k, cast(count(*) as int) as n_clusters from sizes group by 1)
select k, n_clusters, round(avg(coalesce((near - inside) / greatest(near, inside), 0)), 6) + 0.0 as silhouette
from means join counts using (k) group by 1, 2""",
    "elbow": f"""with {CELLS},
placed as (select *, label % k as cluster from cells, (values (2), (3), (5), (10)) as ks(k)),
means as (select k, cluster, dim, avg(x) as m from placed group by 1, 2, 3),
costs as (select k, sum((x - m) * (x - m)) as cost
          from placed join means using (k, cluster, dim) group by 1),
ends as (select min(k) as k0, max(k) as k1, max_by(cost, -k) as c0, max_by(cost, k) as c1 from costs),
away as (select k, cost, (1 - (k - k0) / (k1 - k0) - (cost - c1) / (c0 - c1)) / sqrt(2) as distance
         from costs, ends)
select k, round(cost, 4) as cost, round(distance, 6) + 0.0 as distance,
       row_number() over (order by distance desc, k) = 1 as is_elbow
from away""",
    "choose_k_fitted": """select k, k as n_clusters, true as in_range
from (values (2), (3), (5), (7)) as ks(k)""",
    "center_distance": f"""with {DISTANCES}
select vec_id, prediction, round(cast(distance_to_center as double), 4) as distance_to_center
from distances""",
    "cluster_stats": f"""with {DISTANCES}
select prediction, round(mean_dist, 4) as mean_dist, round(std_dist, 4) as std_dist from stats""",
    "outliers": f"""with {DISTANCES}
select vec_id, prediction, round(cast(distance_to_center as double), 4) as distance_to_center,
       round(mean_dist, 4) as mean_dist, round(std_dist, 4) as std_dist, is_outlier
from flagged""",
    "cosine_to_center": f"""with {CENTERS}
select vec_id, label,
       round(sum(x * m) / sqrt(sum(x * x) * sum(m * m)), 6) + 0.0 as similarity
from cells join centers using (label, dim) group by vec_id, label""",
    "cosine_topk": _topk(""),
    "cosine_topk_nonfinite": _topk("", "not (c.label in (3, 4, 5) and c.vec_id % 2 = 0)"),
    "cosine_topk_scoped": _topk("and c.label = q.label"),
    "semantic_search": f"""with {_wide_chunks()}, {ITEMS},
{QUESTIONS.format(source="asked_items")}, {_hits(5, "questions")} select * from hits""",
    "validation_items": f"with {WIDE}, {ITEMS}, {FIRST}, {KEPT} select * from kept",
    "retrieval_eval": f"{CHECKED} select * from checked",
    "retrieval_summary": f"""{CHECKED}
select count(*) as n_items, count(*) filter (hit_at_1) as n_hit_at_1,
       count(hit_rank) as n_hit_in_k, count(*) filter (n_hits = 0) as n_without_hits,
       round(avg(hit_at_1::int), 6) as hit_rate_at_1,
       round(avg((hit_rank is not null)::int), 6) as hit_rate_in_k
from checked""",
    "plot_points": f"""with {POINTS}
select round(x, 6) + 0.0 as x, round(y, 6) + 0.0 as y, cluster, outlier, section, company
from points""",
    "plot_clusters": _bins("cluster"),
    "plot_outliers": _bins("outlier"),
    "plot_sections": _bins("section"),
    "plot_combined": _bins("company, cluster"),
    "plot_sample": """
select vec_id, label as prediction from embeddings
where ('0x' || substr(md5('7:' || vec_id), 1, 8))::bigint / 2.0 ** 32
      < case when label = 0 then 1.0::double when label = 1 then 1.0::double / 3
             when label between 2 and 8 then 0.5 else 0 end""",
    "plots_written": _bins("company, cluster"),
}
