"""Checking SQL for the registered queries, in DuckDB's dialect.

Written from the definitions, not from the Spark code: one join per clause, plain
window functions, no pruning.
"""

from __future__ import annotations

from workload.catalog import COPIES, ROW_SQL

_LETTERS = r"[\p{L}\p{Nl}][\p{L}\p{Nl}\p{M}]*"
_LETTER_RUN = rf"{_LETTERS}(?:[:·.''‘’․]{_LETTERS})*"
_DIGIT_RUN = r"\p{Nd}+(?:[,;.''‘’․]\p{Nd}+)*"
WORD = f"_*(?:{_LETTER_RUN}|{_DIGIT_RUN})(?:{_LETTER_RUN}|{_DIGIT_RUN}|_+)*"

STORED = "name, year, rating, votes, runtime, certificate, \"cast\", director, genre, plot, movie_id, movie_url"
TEXTS = ("name", "cast", "director", "genre", "plot", "certificate")


def words_of(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '{WORD}')"


_copies = " union all ".join(
    ["select *, 0 as copy from documents"]
    + [f"select *, {c} as copy from documents where {test}" for c, test in COPIES.items()]
)
RAW = f"""
raw as (select {ROW_SQL} from ({_copies}))"""

CLEAN = RAW + """,
first_rows as (
  select * from raw r
  where row_ord = (select min(o.row_ord) from raw o where o.movie_id = r.movie_id)),
clean as (
  select row_ord as doc_id, movie_id, movie_url, movie_name as name,
    case when "cast" = '' then 'Unknown' else "cast" end as "cast",
    case when director = '' then 'Unknown' else director end as director,
    case when genre = '' then 'Unknown' else genre end as genre,
    case when plot = '' then 'Unknown' else plot end as plot,
    case when certificate = '' then 'Unknown' else certificate end as certificate,
    cast(trunc(cast(case when year = '' then '0' else year end as double)) as int) as year,
    cast(case when rating = '' then '0' else rating end as float) as rating,
    cast(replace(case when votes = '' then '0' else votes end, ',', '') as int) as votes,
    cast(replace(rtrim(case when runtime = '' then '0' else runtime end, ' min'), ',', '') as int) as runtime
  from first_rows),
bodies as (
  select *, name || ' ' || "cast" || ' ' || director || ' ' || genre || ' ' || certificate || ' '
    || cast(year as varchar) || ' ' || plot as all_fields from clean)"""

_texts = " union all ".join(
    f"select doc_id, '{f}' as field, \"{f}\" as body from bodies" for f in (*TEXTS, "all_fields")
)
POSTS = CLEAN + f""",
tok as (select doc_id, field, {words_of('body')} as ws from ({_texts})),
occ as (select doc_id, field, len(ws) as dl, unnest(ws) as term, unnest(generate_series(0, len(ws) - 1)) as pos
        from tok where len(ws) > 0),
post as (select field, term, doc_id, any_value(dl) as dl, count(*) as tf from occ group by all),
fs as (select field, count(*) as n, avg(len(ws)) as avg_len from tok where len(ws) > 0 group by field),
dfs as (select field, term, count(*) as df from post group by all)"""

IDF = "ln(1 + (n - df + 0.5) / (df + 0.5))"


def weight(tf: str = "tf", k1: float = 1.2, b: float = 0.75, dl: str = "dl") -> str:
    return f"{tf} / ({tf} + {k1} * (1 - {b} + {b} * {dl} / avg_len))"


def bm25(field: str, *terms: str, **settings) -> str:
    """(doc_id, score) for any of the terms; a repeated term counts each time."""
    values = ", ".join(f"('{t}')" for t in terms)
    return (
        f"(select doc_id, sum({IDF} * {weight(**settings)}) as score from post "
        f"join (values {values}) q(term) using (term) join dfs using (field, term) join fs using (field) "
        f"where field = '{field}' group by doc_id)"
    )


def ones(condition: str) -> str:
    return f"(select doc_id, 1.0::double as score from clean where {condition})"


def term_ones(field: str, condition: str) -> str:
    return f"(select distinct doc_id, 1.0::double as score from post where field = '{field}' and {condition})"


def times(clause: str, factor: float) -> str:
    return f"(select doc_id, score * {factor} as score from {clause})"


def phrase(field: str, words: list[str]) -> str:
    joins = "".join(
        f" join occ o{i} on o{i}.doc_id = o0.doc_id and o{i}.field = o0.field "
        f"and o{i}.term = '{w}' and o{i}.pos = o0.pos + {i}"
        for i, w in enumerate(words) if i
    )
    found = (
        f"select o0.doc_id, o0.field, any_value(o0.dl) as dl, count(*) as freq from occ o0{joins} "
        f"where o0.field = '{field}' and o0.term = '{words[0]}' group by all"
    )
    return _phrase_score(found, field, words)


def _phrase_score(found: str, field: str, words: list[str]) -> str:
    idfs = " + ".join(
        f"(select {IDF} from dfs join fs using (field) where field = '{field}' and term = '{w}')" for w in words
    )
    return f"(select doc_id, ({idfs}) * {weight('freq')} as score from ({found}) join fs using (field))"


def near(field: str, words: list[str], slop: int) -> str:
    """Windows [lo, hi] of aligned places with every word inside and none of the
    smaller windows; each adds 1/(1+hi-lo)."""
    aligned = " union all ".join(
        f"select doc_id, dl, {i} as w, pos - {i} as place from occ where field = '{field}' and term = '{t}'"
        for i, t in enumerate(words)
    )
    n = len(words)
    found = f"""
      with al as ({aligned}),
      starts as (select distinct doc_id, dl, place as lo from al),
      ends as (
        select doc_id, dl, lo, max(nxt) as hi from (
          select s.doc_id, s.dl, s.lo, al.w, min(al.place) as nxt
          from starts s join al on al.doc_id = s.doc_id and al.place >= s.lo group by all)
        group by all having count(*) = {n})
      select doc_id, '{field}' as field, dl, sum(1.0 / (1 + hi - lo)) as freq
      from (select doc_id, dl, hi, max(lo) as lo from ends group by all) where hi - lo <= {slop} group by all"""
    return _phrase_score(found, field, words)


def boolean(must=(), should=(), must_not=()) -> str:
    """One join per clause over the table of documents."""
    joins, score, tests = [], [], []
    for role, group in (("m", must), ("s", should), ("n", must_not)):
        for i, clause in enumerate(group):
            name = f"{role}{i}"
            joins.append(f" left join {clause} {name} on {name}.doc_id = d.doc_id")
            if role != "n":
                score.append(f"coalesce({name}.score, 0)")
            if role == "m":
                tests.append(f"{name}.doc_id is not null")
            if role == "n":
                tests.append(f"{name}.doc_id is null")
    if not must:
        tests.append("(" + " or ".join(f"s{i}.doc_id is not null" for i in range(len(should))) + ")")
    return (
        f"(select d.doc_id, {' + '.join(score)} as score from clean d{''.join(joins)} "
        f"where {' and '.join(tests)})"
    )


def fuzzy(field: str, text: str, edits: int, limit: int) -> str:
    """Terms by edit distance, or by one swapped pair at i of the text and j of
    the term with plain edits around it (two swaps: none of the words used
    here). DuckDB counts bytes, so other characters become one that no text has."""
    n = len(text)
    return f"""(
      with v as (
        select field, term, df, least(length(term), {n}) as shorter, regexp_replace(term, '[^ -~]', '~', 'g') as w
        from dfs where field = '{field}' and abs(length(term) - {n}) <= {edits}),
      ways as (
        select term, levenshtein(w, '{text}') as e from v
        union all
        select term, 1 + levenshtein(substr('{text}', 1, i - 1), substr(w, 1, j - 1))
                       + levenshtein(substr('{text}', i + 2), substr(w, j + 2))
        from v, (select unnest(range(1, {n})) as i), (select unnest(range(1, {n + edits})) as j)
        where substr(w, j, 2) = reverse(substr('{text}', i, 2))),
      near as (select field, term, df, shorter, min(e) as e from v join ways using (term) group by all),
      best as (
        select field, term, df, 1 - e / shorter as likeness from near
        where e <= {edits} and (e = 0 or e < shorter) order by 4 desc, 2 limit {limit})
      select doc_id, sum(likeness * ln(1 + (n - top + 0.5) / (top + 0.5)) * {weight()}) as score
      from post join best using (field, term) join fs using (field), (select max(df) as top from best)
      group by doc_id)"""


def scored(clause: str) -> str:
    return f"with {POSTS} select doc_id, round(score, 4) as score from {clause}"


def ranked(clause: str, k: int) -> str:
    return (
        f"(select doc_id, round(score, 4) as score, "
        f"cast(row_number() over (order by round(score, 4) desc, doc_id) as int) as rank from {clause} "
        f"order by rank limit {k})"
    )


def hits(clause: str, k: int) -> str:
    return f"with {POSTS} select rank, score, {STORED} from {ranked(clause, k)} join clean using (doc_id)"


_CLAUSES = {
    "term_match": bm25("all_fields", "comedy", "actor", "12"),
    "fielded_term": bm25("genre", "short", "drama"),
    "int_exact": ones("year = 1984"),
    "float_exact": ones("rating = 6.8::float"),
    "int_range_open": ones("votes >= 900"),
    "float_range_open": ones("rating <= 2.5::float"),
    "exclusive_range_is_inclusive": ones("year between 1950 and 1960"),
    "text_range": term_ones("name", "term >= 'the' and term < 'thm'"),
    "prefix": term_ones("genre", "starts_with(term, 'comed')"),
    "wildcard": term_ones("plot", "term like 'th_r%e'"),
    "regex": term_ones("plot", "regexp_full_match(term, '(in)+g?[aeiou]t.*')"),
    "fuzzy": fuzzy("plot", "then", 2, 1_000_000_000),
    "fuzzy_limited": fuzzy("plot", "thsi", 2, 50),
    "bool_empty_word": bm25("genre", "drama"),
    "phrase": phrase("plot", ["of", "the"]),
    "phrase_slop": near("plot", ["the", "on", "and"], 6),
    "bool_must_should_not": boolean(
        [bm25("genre", "drama"), ones("rating between 4 and 9")],
        [bm25("all_fields", "the", "of"), ones("year >= 1990"), times(bm25("cast", "actor"), 0.5)],
        [bm25("genre", "short"), ones("votes between 0 and 100")],
    ),
    "nested_bool": boolean(
        [
            boolean((), [bm25("genre", "comedy"), phrase("director", ["director", "7"])]),
            ones("runtime between 10 and 150"),
        ],
        [boolean([bm25("all_fields", "the"), bm25("all_fields", "and")]), ones("year = 1999")],
        [boolean([bm25("certificate", "en"), ones("rating between 0 and 3")])],
    ),
    "numeric_or_words": boolean(
        (), [ones("rating between 9.5 and 10"), bm25("genre", "action")], [ones("votes = 0")]
    ),
    "numbers_only": boolean(
        [ones("year between 1960 and 1999")],
        [ones("rating between 8 and 10"), times(ones("votes >= 500"), 3)],
    ),
    "only_must_not_empty": bm25("genre", "comedy"),
    "boost": times(bm25("all_fields", "action", "unknown"), 2.5),
    "match_all": ones("true"),
    "unindexed_field_empty": bm25("genre", "drama"),
}

_TOP = boolean(
    (), [bm25("all_fields", "comedy", "director", "the"), bm25("cast", "actor"), term_ones("all_fields", "starts_with(term, 'uni')")]
)
_PLUS_RANGE = boolean([ones("rating between 8 and 10")], [bm25("all_fields", "drama")])

_KEPT = """case when dl < 40 then dl else 24 + ((dl - 24) >> s << s) end"""
_SHIFT = "greatest(length(bin(dl - 24)) - 4, 0)"

_BYTE4 = f"""
with {POSTS},
short as (select *, {_KEPT} as kept from (select *, case when dl < 40 then 0 else {_SHIFT} end as s from post)),
scores as (
  select doc_id, sum({IDF} * {weight(k1=0.9, b=0.4, dl='kept')}) as score
  from short join dfs using (field, term) join fs using (field)
  where field = 'all_fields' and term in ('the', 'of', 'and') group by doc_id)
select rank, doc_id, score from {ranked('scores', 10)}"""

_BATCH = f"""
with {POSTS},
q as (select item_id as qid, unnest({words_of('text')}) as term from benchmark),
scores as (
  select qid, doc_id, round(sum({IDF} * {weight()}), 4) as score
  from q join post using (term) join dfs using (field, term) join fs using (field)
  where field = 'all_fields' group by all)
select qid, rank, doc_id, score from (
  select *, cast(row_number() over (partition by qid order by score desc, doc_id) as int) as rank from scores)
where rank <= 5"""

_SNIPPET = """
  case when genre like '%Short%' then 'The short film is titled ' else 'The film is titled ' end || movie_name || '.'
  || case when "cast" <> '' then 'It stars ' || "cast" || '.' else '' end
  || case when director <> '' then 'It was directed by ' || director || '.' else '' end
  || case when genre <> '' then 'It is of the genre(s) '
       || replace(replace(replace(genre, ',Short', ''), 'Short,', ''), 'Short', '') || '.' else '' end
  || case when year <> '' then 'It was released on '
       || cast(cast(trunc(cast(year as double)) as int) as varchar) || '.' else '' end
  || case when plot <> '' then 'A short description is as follows: ' || plot else '' end"""

_SOURCE_COLUMNS = (
    "movie_id, movie_name, year, rating, votes, runtime, certificate, \"cast\", director, genre, plot, "
    "meta_score, gross, movie_url"
)
DISTINCT = RAW + f""",
kept as (select {_SOURCE_COLUMNS}, min(row_ord) as row_ord from raw group by all)"""


def _encode(source: str, key: str, text: str) -> str:
    """Mean of the token vectors of all words, 16 numbers each."""
    digit = "('0x' || substr(md5(t || ':0'), 2 * d + 1, 2))::int"
    return f"""(
      select {key}, d, cast(avg(({digit} - 127.5) / 127.5) as float) as v
      from (select {key}, unnest({words_of(text)}) as t from {source}), (select unnest(range(16)) as d)
      group by all)"""


ENCODED = DISTINCT + f""",
docs_text as (select row_ord as doc_id, {_SNIPPET} as body from kept),
dv as {_encode('docs_text', 'doc_id', 'body')},
qv as {_encode('(select item_id as qid, text from benchmark)', 'qid', 'text')},
ips as (select qid, doc_id, round(sum(cast(dv.v as double) * cast(qv.v as double)), 4) as score
        from dv join qv using (d) group by all),
dense_hits as (select *, cast(row_number() over (partition by qid order by score desc, doc_id) as int) as rank from ips)"""

VECTORS = """
vec as (select vec_id as doc_id, label, unnest(range(len(embedding))) as d,
          unnest(embedding) * cast(vec_id % 3 + 1 as float) as v from embeddings),
pooled as (select label, d, sum(case when doc_id % 4 = 0 then 0 else v::double end)
             / greatest(sum(case when doc_id % 4 = 0 then 0 else 1 end), 1e-9) as v from vec group by all)"""


def _inner_products(left: str, right: str, k: int) -> str:
    return f"""
select qid, rank, doc_id, score from (
  select *, cast(row_number() over (partition by qid order by score desc, doc_id) as int) as rank from (
    select qid, doc_id, round(sum(a.v::double * b.v::double), 6) as score
    from {left} a join {right} b using (d) group by all))
where rank <= {k}"""


_LINK = "'https://www.imdb.com/' || nullif(regexp_extract(html, '<a [^>]*href=\"([^\"]*)\"', 1), '')"

ORACLES: dict[str, str] = {
    **{name: scored(clause) for name, clause in _CLAUSES.items()},
    "clean_catalog": f"""with {CLEAN} select movie_id, name, "cast", director, genre, plot, certificate,
        year, rating, votes, runtime, movie_url, doc_id as row_ord from clean""",
    "dedup_key_first": f"with {CLEAN} select movie_id, row_ord, votes from first_rows",
    "dedup_full_row": f"with {DISTINCT} select * from kept",
    "all_fields_text": f"with {CLEAN} select movie_id, all_fields from bodies",
    "row_ids": f"with {CLEAN} select movie_id, row_number() over (order by doc_id) - 1 as doc_pos from clean",
    "row_ids_sparse": f"""with {RAW} select row_ord,
        row_number() over (order by row_ord * 7919000017 % 1099511627776) - 1 as doc_pos from raw""",
    "csv_round_trip": f"with {RAW} select {_SOURCE_COLUMNS} from raw",
    "snippet": f"with {DISTINCT} select row_ord, {_SNIPPET} as snippet from kept",
    "genre_without_short": f"""with {RAW} select row_ord,
        replace(replace(replace(genre, ',Short', ''), 'Short,', ''), 'Short', '') as genre from raw""",
    "id_patch": f"""with {RAW} select row_ord, coalesce('fix' || cast(l.doc_id as varchar), movie_id) as movie_id
        from raw left join labels l on movie_id = 'tt' || lpad(cast(l.doc_id as varchar), 12, '0')""",
    "page_urls": f"with {RAW} select row_ord, 'https://imdb.com/title/' || movie_id as page_url from raw",
    "tokenize_counts": f"""with {POSTS} select field, count(*) as tokens, count(distinct term) as terms
        from occ where field <> 'all_fields' group by field""",
    "positions": f"""with {POSTS} select field, term, doc_id, cast(count(*) as int) as tf,
        string_agg(cast(pos as varchar), ',' order by pos) as positions
        from occ where field <> 'all_fields' group by all""",
    "term_freq": f"""with {POSTS} select term, doc_id, cast(tf as int) as tf, cast(dl as int) as dl
        from post where field = 'all_fields'""",
    "doc_freq": f"with {POSTS} select field, term, df from dfs",
    "field_stats": f"with {POSTS} select field, n as n_docs, round(avg_len, 6) as avg_len from fs",
    "idf": f"with {POSTS} select field, term, round({IDF}, 6) as idf from dfs join fs using (field)",
    "byte4_norms": f"""with {POSTS} select field, doc_id, cast(dl as int) as dl, cast({_KEPT} as int) as kept from (
        select *, case when dl < 40 then 0 else {_SHIFT} end as s from (
          select field, doc_id, len(ws) as dl from tok where len(ws) > 0))""",
    "bm25_topk": hits(_TOP, 10),
    "bm25_byte4_topk": _BYTE4,
    "bm25_plus_range": hits(_PLUS_RANGE, 5),
    "term_topk_pruned": hits(bm25("all_fields", "the", "comedy"), 10),
    "top_rated": hits(ones("rating between 8 and 10"), 5),
    "batch_queries_topk": _BATCH,
    "batch_queries_pruned_topk": _BATCH,
    "result_card": f"""with {POSTS} select rank, 'https://imdb.com/title/' || movie_id as title_url,
        movie_url as poster_url, name, score, director, year, rating
        from {ranked(_TOP, 10)} join clean using (doc_id)""",
    "hits_json_roundtrip": hits(_TOP, 10),
    "pad_truncate_mask": f"""select doc_id,
        array_to_string(list_concat(ws[1:512], list_resize([]::varchar[], greatest(512 - len(ws), 0), '<pad>')), ' ') as tokens,
        repeat('1', least(len(ws), 512)) || repeat('0', greatest(512 - len(ws), 0)) as mask
        from (select doc_id, {words_of('text')} as ws from documents)""",
    "masked_mean_pool": f"with {VECTORS} select label, cast(d as int) as dim, round(v, 6) + 0.0 as value from pooled",
    "inner_product_batch_topk": f"with {VECTORS}"
    + _inner_products("(select label::bigint as qid, d, v from pooled)", "(select doc_id, d, v from vec)", 7),
    "inner_product_blocks_topk": f"with {VECTORS}"
    + _inner_products("(select doc_id as qid, d, v from vec)", "(select doc_id, d, v from vec)", 3),
    "inner_product_topk": f"with {VECTORS} select rank, doc_id, score from ("
    + _inner_products("(select 0 as qid, d, avg(v::double) as v from vec group by d)", "(select doc_id, d, v from vec)", 5)
    + ")",
    "k_exceeds_n": f"with {VECTORS}"
    + _inner_products("(select doc_id as qid, d, v from vec)", "(select label::bigint as doc_id, d, v from pooled)", 1000),
    "encode_documents": f"""with {ENCODED} select doc_id, cast(d as int) as dim, round(cast(v as double), 5) + 0.0 as value
        from dv""",
    "dense_append": f"""with {ENCODED} select doc_id + s as doc_id, cast(d as int) as dim, round(cast(v as double), 5) + 0.0 as value
        from dv, (values (0), (1000000000000)) as t(s)""",
    "encode_search": f"with {ENCODED} select qid, rank, doc_id, score from dense_hits where rank <= 3",
    "hits_join_catalog": f"""with {ENCODED} select qid, rank, movie_name as name, year, rating, votes, runtime,
        certificate, "cast", director, genre, plot, movie_id, movie_url, score
        from dense_hits join kept on row_ord = doc_id where rank <= 5""",
    "url_segment": """select page_id, case when len(string_split(url, '/')) >= 2
        then string_split(url, '/')[-2] || '-curr' end as image_id from pages""",
    "first_link_extract": f"select page_id, {_LINK} as link from pages",
    "attach_image_url": f"""with {RAW} select r.row_ord, r.movie_id, r.movie_name, {_LINK} as image_url
        from raw r left join pages on r.movie_id = 'tt' || lpad(cast(page_id as varchar), 12, '0')""",
}
