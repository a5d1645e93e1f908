"""The results of the queries on training data in SQL, where SQL can express them."""

from __future__ import annotations

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _crc32(text: str) -> str:
    """The unsigned checksum of a text's bytes, bit by bit."""
    byte = f"('0x' || substr(hex(encode({text})), 2 * (i // 8) + 1, 2))::bigint"
    bits = f"list_transform(range(octet_length(encode({text})) * 8), lambda i: ({byte} >> (i % 8)) & 1)"
    # the polynomial of CRC-32, reflected
    step = "lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1))"
    return f"xor(list_reduce(list_concat([4294967295], {bits}), {step}), 4294967295)"


_ONE_WORD = r"regexp_extract_all(translate(coalesce(text, ''), " + _LOWER + r"), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLES: dict[str, str] = {
    "op2_nn_descent_embeddings": """
        with recursive unit as materialized (select vec_id, embedding::double[] as v from embeddings),
        link as materialized (
            select a.vec_id as x, b.vec_id as y from unit a join unit b on a.vec_id <> b.vec_id
            where list_cosine_similarity(a.v, b.v) >= 0.9),
        reach as (select vec_id as x, vec_id as y from unit
                  union select r.x, l.y from reach r join link l on l.x = r.y)
        select u.vec_id, (select count(*) from link where x = u.vec_id) as n_links,
               min(r.y) as component_id, u.vec_id = min(r.y) as kept
        from unit u join reach r on r.x = u.vec_id group by u.vec_id""",
    "op4_deletion_neighbourhood_lines": rf"""
        with split as (select doc_id, string_split(text, chr(10)) as parts from documents),
        line as materialized (
            select doc_id, i as line, parts[i] as body, row_number() over (order by doc_id, i) as pos,
                   list_filter(string_split_regex(translate(parts[i], {_LOWER}), '[ \t\n\x0B\f\r]+'), lambda w: w <> '') as words
            from (select doc_id, parts, unnest(range(1, len(parts) + 1)) as i from split)),
        rep as materialized (select words, min(pos) as pos from line where len(words) >= 4 group by words),
        cut as materialized (
            select words, pos, i, list_concat(words[:i - 1], words[i + 1:]) as rest
            from (select words, pos, unnest(range(1, len(words) + 1)) as i from rep where len(words) >= 8)),
        near as (
            select words from (select words, pos, min(pos) over (partition by rest, i) as first from cut) where first < pos
            union select c.words from cut c join rep r on r.words = c.rest where len(r.words) >= 8 and r.pos < c.pos
            union select r.words from cut c join rep r on r.words = c.rest where len(r.words) >= 8 and c.pos < r.pos),
        told as (
            select l.*, len(l.words) >= 4 and (l.pos > r.pos or n.words is not null) as gone
            from line l left join rep r on r.words = l.words left join near n on n.words = l.words)
        select doc_id, coalesce(string_agg(body, chr(10) order by line) filter (where not gone), '') as text,
               count(*) as n_lines, count(*) filter (where gone) as n_removed
        from told group by doc_id""",
    "op8_golomb_exact_dedup": f"""
        with t as (select doc_id, translate(coalesce(text, ''), {_LOWER}) as body from documents)
        select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size,
               doc_id = max(doc_id) over g as kept, sha256(body) as text_sha256
        from t window g as (partition by body)""",
    # the markup of the given pages is regular enough for patterns
    "op9_nearest_url_extraction": r"""
        with block as (
            select page_id, url,
                   string_split_regex(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '</?(?:h1|p)>') as found
            from pages),
        plain as (
            select page_id, url, list_transform(found, lambda x: trim(regexp_replace(
                       replace(replace(replace(replace(replace(replace(regexp_replace(x, '</?b>', '', 'g'), '<br>', ' '),
                           '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', ''''), '&amp;', '&'), '\s+', ' ', 'g'))) as texts
            from block)
        select page_id, url, text, length(text) as n_chars
        from (select page_id, url,
                     array_to_string(list_filter(texts, lambda x: x <> ''), chr(10) || chr(10)) as text from plain)""",
    "op11_gram_index_spelling": f"""
        with recursive run as materialized (
            select doc_id, r, length(r) as len, count(*) as n
            from (select doc_id, unnest(regexp_extract_all(translate(text, {_LOWER}), '[A-Za-z\u00C0-\u00FF]+')) as r from documents)
            where length(r) >= 5 group by all),
        hashed as materialized (select *, {_crc32("(doc_id || ':' || r)")} as h from run),
        slip as (select case when h % 97 = 0 then substr(r, 1, h % len) || substr(r, h % len + 2) else r end as word, n from hashed),
        word as materialized (
            select word, sum(n)::bigint as n from slip where length(word) >= 5 group by word having sum(n) >= 3),
        cut as materialized (
            select word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest
            from (select word, n, unnest(range(1, length(word) + 1)) as i from word)),
        near as (
            select a.word, b.word as other, b.n as n from cut a join cut b using (rest, i) where a.word <> b.word
            union select c.word, w.word, w.n from cut c join word w on w.word = c.rest
            union select w.word, c.word, c.n from cut c join word w on w.word = c.rest),
        best as (select word, count(*) as n_near, arg_min(other, struct_pack(m := -n, o := other)) as other, max(n) as top
                 from near group by word),
        form as materialized (
            select w.word, w.n, coalesce(n_near, 0) as n_near, case when top >= 2 * w.n then other end as form,
                   case when top >= 2 * w.n then top end as form_n
            from word w left join best using (word)),
        chain as (select word, word as root, form as next from form
                  union all select c.word, f.word, f.form from chain c join form f on f.word = c.next)
        select word, form, c.root, n, n_near, form_n from form join chain c using (word) where c.next is null""",
    "op12_importance_resampling": f"""
        with word as materialized (
            select doc_id, {_ONE_WORD} as w, false as wanted from documents
            union all select null, {_ONE_WORD}, true from benchmark),
        feature as materialized (
            select doc_id, wanted, f, count(*) as n from (
                select doc_id, wanted, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) as f
                from word)
            group by all),
        bucket as materialized (select f, {_crc32("f")} % 10000 as b from (select distinct f from feature)),
        bin as (
            select r.range as b, coalesce(s, 0) as s, coalesce(t, 0) as t
            from range(10000) r left join (
                select b, sum(n) filter (where not wanted) as s, sum(n) filter (where wanted) as t
                from feature join bucket using (f) group by b) c on c.b = r.range),
        gain as materialized (
            select b, floor(1000 * ln(((t + 1) * (sum(s) over () + 10000))::double / ((s + 1) * (sum(t) over () + 10000))::double))::bigint as g
            from bin),
        mean as (
            select doc_id, sum(n)::bigint as n_features, floor(sum(g * n)::double / sum(n))::bigint as weight
            from feature join bucket using (f) join gain using (b) where not wanted group by doc_id),
        scored as (
            select doc_id, len(w) as n_words, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
                   coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || doc_id), 1, 8))::bigint + 0.5::double) / 4294967296)))::bigint as score
            from word left join mean using (doc_id) where not wanted),
        drawn as (
            select doc_id, row_number() over (order by score desc, doc_id) as place, count(*) over () as total
            from scored where n_words >= 20)
        select doc_id, n_features, weight, score, case when place <= 25 * total // 100 then place end as rank
        from scored left join drawn using (doc_id)""",
}
