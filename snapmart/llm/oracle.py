"""DuckDB SQL of the queries that SQL can express.

The others learn a model, hash with a function DuckDB lacks, or use a tokenizer; the tests hold them against brute force.
"""

from __future__ import annotations

#: ASCII lower-casing, as translate() spells it.
FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL = {
    "op1_warc_transactions": """
        with hashed as (
          select page_id, coalesce(html, '') as payload, sha1(encode(coalesce(html, ''))) as hex from pages
        ), numbered as (
          select page_id, cast(octet_length(encode(payload)) as bigint) as payload_bytes, hex,
            min(page_id) over (partition by payload) as first_page
          from hashed
        )
        select page_id, payload_bytes,
          list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            cast(((cast(concat('0x', substr(hex, cast((i // 4) * 5 + 1 as bigint), 5)) as bigint)
              >> cast(15 - 5 * (i % 4) as bigint)) & 31) + 1 as bigint), 1)), 'string_agg', '') as payload_digest,
          case when page_id = first_page then 'response' else 'revisit' end as record_type,
          case when page_id <> first_page then first_page end as refers_to
        from numbered
    """,
    "op3_line_cleaning": r"""
        with worded as (
          select doc_id, coalesce(text, '') as t,
            regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words,
            list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as lines
          from documents
        ), places as (
          select doc_id, words, unnest(range(1, len(words) - 1)) as i from worded
        ), grams as (
          select doc_id, i, count(*) over (
            partition by doc_id, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]) as n
          from places
        ), covered as (
          select distinct doc_id, unnest([i, i + 1, i + 2]) as place from grams where n > 1
        ), repeated as (
          select doc_id, count(*) as n from covered group by doc_id
        ), line as (
          select doc_id, unnest(lines) as l from worded
        ), split as (
          select doc_id, l, regexp_extract_all(l, '[^\x20\x09-\x0D]+') as w,
            length(regexp_replace(l, '[\x20\x09-\x0D]+', '', 'g')) as chars from line
        ), ruled as (
          select doc_id, chars, case
            when len(regexp_extract_all(l, '[|»›•·]| > ')) >= 2 or len(w) <= 6 and 2 * len(list_filter(w, lambda x:
              regexp_full_match(x, '(?i)[.,:]*(?:home|menu|login|logout|search|contact|about|help|next|previous|share|sitemap)[.,:]*'))) > len(w)
              then 'navigation'
            when regexp_matches(l, '(?i)all rights reserved|privacy policy|terms of (?:use|service)|cookie|javascript|lorem ipsum|click here|read more|sign up|subscribe|powered by|licensed under|license')
              then 'boilerplate'
            when not regexp_matches(w[-1], '[.!?…:;"''”’»)\]。！？]$')
              or 3 * len(regexp_extract_all(l, '[#*$%&|<>]|!!+|\?\?+')) > len(w) then 'punctuation' end as rule
          from split
        ), lost as (
          select doc_id,
            cast(sum(case when rule = 'punctuation' then chars else 0 end) as bigint) as lost_punctuation,
            cast(sum(case when rule = 'navigation' then chars else 0 end) as bigint) as lost_navigation,
            cast(sum(case when rule = 'boilerplate' then chars else 0 end) as bigint) as lost_boilerplate
          from ruled group by doc_id
        ), measured as (
          select doc_id, cast(len(words) as bigint) as n_words,
            cast(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) as bigint) as word_chars,
            cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '', 'g')) as bigint) as n_symbols,
            cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
            cast(coalesce(repeated.n, 0) as bigint) as n_repeat_words,
            coalesce(lost_punctuation, 0) as lost_punctuation, coalesce(lost_navigation, 0) as lost_navigation,
            coalesce(lost_boilerplate, 0) as lost_boilerplate
          from worded left join repeated using (doc_id) left join lost using (doc_id)
        ), based as (
          select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from measured
        )
        select *, not base_failed and 2 * (lost_punctuation + lost_navigation + lost_boilerplate) <= word_chars as kept
        from based
    """,
    "op6_exact_dedup": f"""
        with folded as (select doc_id, {FOLDED} as t from documents),
        grouped as (
          select doc_id, t, max(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size from folded
        )
        select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(t) as text_sha256 from grouped
    """,
    "op11_de_bruijn_compaction": r"""
        with worded as (
          select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents
        ), places as (
          select doc_id, words, unnest(range(1, len(words) - 48)) as i from worded
        ), firsts as (
          select doc_id, i, min(doc_id) over (partition by array_to_string(words[i:i + 49], ' ')) as first_doc from places
        ), gone as (
          select distinct doc_id, unnest(range(i, i + 50)) as place from firsts where first_doc < doc_id
        ), word as (
          select doc_id, unnest(words) as word, unnest(range(1, len(words) + 1)) as place from worded
        ), kept as (
          select doc_id, count(*) as n, string_agg(word, ' ' order by place) as t
          from word anti join gone using (doc_id, place) group by doc_id
        )
        select doc_id, cast(len(words) as bigint) as n_words, cast(len(words) - coalesce(n, 0) as bigint) as n_removed,
          sha256(coalesce(t, '')) as kept_sha256
        from worded left join kept using (doc_id)
    """,
    "op12_sorted_list_variants": f"""
        with recursive crc as (
          select list_transform(range(256), lambda b: list_reduce(range(8), lambda c, x:
            case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, b)) as step
        ), run as (
          select coalesce(cast(doc_id as varchar), '') as id, unnest(regexp_extract_all({FOLDED}, '[a-zÀ-ÿ]+')) as run from documents
        ), counted as (
          select id, run, count(*) as n from run group by id, run
        ), coded as (
          select run, n, hex(encode(id || ':' || run)) as hex from counted
        ), hashed as (
          select run, n, xor(list_reduce(
            list_transform(range(cast(length(hex) // 2 as bigint)), lambda i: cast(concat('0x', substr(hex, cast(2 * i + 1 as bigint), 2)) as bigint)),
            lambda c, b: xor(c >> 8, step[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) as h
          from coded, crc
        ), lost as (
          select n, case when h % 97 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word
          from hashed
        ), words as (
          select word, cast(sum(n) as bigint) as n from lost where length(word) >= 5 group by word having sum(n) >= 3
        ), places as (
          select word, n, unnest(range(1, length(word) + 1)) as i from words
        ), masked as (
          select word, n, i, substr(word, 1, i - 1) as head, substr(word, i + 1) as tail from places
        ), replaced as (
          select a.word, b.word as near, b.n as m from masked a join masked b using (head, tail, i) where a.word <> b.word
        ), shortened as (
          select distinct w.word, s.word as near, w.n, s.n as m
          from masked w join words s on s.word = w.head || w.tail
        ), near as (
          select word, near, m from replaced
          union all select word, near, m from shortened
          union all select near, word, n from shortened
        ), judged as (
          select word, count(*) as n_near, max(m) as most, arg_min(near, {{'m': -m, 'near': near}}) as best from near group by word
        ), formed as (
          select word, n, coalesce(n_near, 0) as n_near, case when most >= 2 * n then best end as form,
            case when most >= 2 * n then most end as form_n
          from words left join judged using (word)
        ), led as (
          select word, word as stop, form as onward from formed
          union all select led.word, led.onward, formed.form from led join formed on formed.word = led.onward
        )
        select formed.word, form, stop as root, n, n_near, form_n
        from formed join led on led.word = formed.word and led.onward is null
    """,
    "op13_setm_collocations": rf"""
        with piece as (
          select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array({FOLDED}, '[.,;:!?\x0A-\x0D]')) as p from documents
        ), worded as (
          select lang, regexp_extract_all(p, '[^\x20\x09]+') as w from piece
        ), total as (
          select lang, cast(sum(len(w)) as bigint) as n from worded group by lang
        ), place as (
          select lang, w, unnest(range(1, len(w) + 1)) as i from worded
        ), grown as (
          select lang, w[i:i + k - 1] as words, k
          from place, (select unnest([1, 2, 3, 4, 5]) as k) where i + k - 1 <= len(w)
        ), phrase as (
          select lang, k, words, count(*) as f from grown group by lang, k, words having count(*) >= 100
        ), cut as (
          select p.lang, p.words, p.k, p.f as a, h.f as l, t.f as r, h.k as head_words,
            cast((1000::hugeint * p.f * n) // (h.f::hugeint * t.f) as bigint) as score, n
          from phrase p join total using (lang)
            join phrase h on h.lang = p.lang and h.k < p.k and h.words = p.words[1:h.k]
            join phrase t on t.lang = p.lang and t.k = p.k - h.k and t.words = p.words[h.k + 1:p.k]
          where p.k > 1
        ), best as (
          select *, row_number() over (partition by lang, words order by score, head_words) as place from cut
        ), inner_part as (
          select p.lang, p.words[s.i:s.i + s.k - 1] as words, max(p.f) as longer
          from phrase p join (select * from (select unnest([1, 2, 3, 4]) as i), (select unnest([2, 3, 4]) as k)) s
            on s.k < p.k and s.i + s.k - 1 <= p.k
          group by all
        ), left_over as (
          select b.* from best b left join inner_part using (lang, words)
          where place = 1 and (longer is null or longer < a)
        ), ranked as (
          select *, array_to_string(words, ' ') as text from left_over
        ), numbered as (
          select *, row_number() over (partition by lang order by score desc, a desc, text) as rank from ranked
        )
        select lang, rank, text as phrase, a, l, r, n, score from numbered where rank <= 2000
    """,
}
