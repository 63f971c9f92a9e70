"""Oracle SQL of the queries that SQL can express."""

from __future__ import annotations

from evenkeel.llm import codes, licenses, mixing, negatives, revisits


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical(text: str) -> str:
    lowered = f"lower(chr(10) || {text})"
    out = f"regexp_replace({lowered}, {quoted(licenses.COPYRIGHT_LINE)}, chr(10), 'g')"
    out = f"regexp_replace({out}, {quoted(r'[^\p{L}\p{N}' + chr(92) + 'n]+')}, '  ', 'g')"
    out = f"'  ' || replace({out}, chr(10), '  ' || chr(10) || '  ') || '  '"
    for kept, other in licenses.SPELLINGS:
        out = f"replace({out}, {quoted(licenses.apart(other))}, {quoted(licenses.apart(kept))})"
    return f"trim(regexp_replace({out}, ' *' || chr(10) || ' *', chr(10), 'g'), ' ')"


def _digest(lines: str) -> str:
    return f"md5(trim(regexp_replace({lines}, '[ ' || chr(10) || ']+', ' ', 'g'), ' '))"


def license_scan() -> str:
    known = ", ".join(f"({quoted(key)}, {quoted(text)})" for key, text in licenses.known_texts())
    listed = ", ".join(quoted(text) for text in licenses.TEXTS.values())
    return f"""
WITH texts(license, text) AS (VALUES {known}),
known AS (SELECT {_digest(_canonical('text'))} AS digest, min(license) AS license FROM texts GROUP BY 1),
spelled AS (SELECT doc_id, source, replace([{listed}][(doc_id // 40) % {len(licenses.TEXTS)} + 1], ' license ', ' licence ')
                   AS text FROM documents WHERE doc_id % 40 = 0),
changed AS (SELECT doc_id, source, CASE WHEN doc_id % 80 = 0 THEN upper(text) ELSE replace(text, ',', ' ;') END AS text
            FROM spelled),
scanned AS (SELECT doc_id, text FROM documents UNION ALL
            SELECT -1 - doc_id, 'Copyright (c) 2020 ' || coalesce(source, '') || chr(10)
                   || replace(text, chr(10), chr(13) || chr(10) || '  * ') FROM changed),
canon AS (SELECT doc_id, {_canonical('text')} AS lines FROM scanned),
lines AS (SELECT DISTINCT doc_id, md5(replace(unnest(string_split(lines, chr(10))), '  ', ' ')) AS digest FROM canon),
notices AS (SELECT l.doc_id, string_agg(DISTINCT k.license, ',' ORDER BY k.license) AS notices
            FROM lines l JOIN known k USING (digest) GROUP BY l.doc_id)
SELECT c.doc_id, {_digest('c.lines')} AS digest, k.license, coalesce(n.notices, '') AS notices
FROM canon c LEFT JOIN known k ON k.digest = {_digest('c.lines')} LEFT JOIN notices n ON n.doc_id = c.doc_id"""


def mix() -> str:
    weights = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(mixing.WEIGHTS))
    draw = ("(('0x' || substr(md5(seed || '|' || coalesce(cast(doc_id AS varchar), 'null')), 1, "
            f"{mixing.DRAW_DIGITS}))::bigint::double / {mixing.DRAWS!r})")
    copies = f"(floor(rate) + CASE WHEN {draw} < rate - floor(rate) THEN 1 ELSE 0 END)::bigint"
    word = "'[^ ' || chr(9) || '-' || chr(13) || ']+'"
    return f"""
WITH sized AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, {word})), 0)::bigint AS size FROM documents),
sums AS (SELECT source, sum(size)::bigint AS source_size,
                row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM sized GROUP BY source),
weighed AS (SELECT *, CASE place % {len(mixing.WEIGHTS)} {weights} END AS weight FROM sums),
ordered AS (SELECT *, row_number() OVER (ORDER BY source_size::double / weight, place) AS k FROM weighed),
levels AS (  -- the level if the k - 1 least sources for their weight are full
    SELECT *, ({mixing.SHARE!r} * (SELECT sum(source_size) FROM sums)
               - {mixing.MOST} * coalesce(sum(source_size) OVER before, 0))
              / sum(weight) OVER rest AS level
    FROM ordered WINDOW before AS (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                        rest AS (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
chosen AS (SELECT min(k) AS k FROM levels WHERE weight * level < {mixing.MOST} * source_size),
targets AS (
    SELECT o.*, CASE WHEN c.k IS NULL OR o.k < c.k THEN ({mixing.MOST} * o.source_size)::double
                     ELSE o.weight * (SELECT level FROM levels l WHERE l.k = c.k) END AS target
    FROM ordered o, chosen c),
rates AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM targets),
tried AS (
    SELECT r.source, seed, abs(sum(size * {copies}) - any_value(target)) AS off
    FROM sized s JOIN rates r ON s.source IS NOT DISTINCT FROM r.source, range({mixing.SEEDS}) AS t(seed)
    GROUP BY r.source, seed),
seeds AS (SELECT source, arg_min(seed, (off, seed)) AS seed FROM tried GROUP BY source),
drawn AS (
    SELECT doc_id, size, source_size, target, {copies} AS copies
    FROM sized s JOIN rates r ON s.source IS NOT DISTINCT FROM r.source
                 JOIN seeds d ON s.source IS NOT DISTINCT FROM d.source)
SELECT doc_id, size, source_size, target, copies, size * copies AS taken FROM drawn"""


def _url_key(url: str) -> str:
    bare = (f"regexp_replace(regexp_replace(trim({url}), '#.*$', ''), "
            f"'(?i)^[a-z][a-z0-9+.-]*://', '')")
    host = (f"regexp_replace(lower(regexp_extract({bare}, '^[^/?]*', 0)), "
            f"'^www[0-9]*\\.|:(?:80|443)$', '', 'g')")
    path = f"regexp_replace(regexp_extract({bare}, '^[^/?]*([^?]*)', 1), '/+$', '')"
    kept = (f"list_sort(list_filter(string_split(regexp_extract({bare}, '\\?(.*)$', 1), '&'), "
            f"lambda p: p <> '' AND NOT regexp_matches(p, {quoted(revisits.TRACKING)})))")
    return (f"{host} || {path} || CASE WHEN len({kept}) > 0 "
            f"THEN '?' || array_to_string({kept}, '&') ELSE '' END")


def revisit() -> str:
    """The captures of the query, then an as-of join."""
    when = "1700000000 + page_id % 1000 * 3600"
    again = "regexp_replace(url, '^https?://', 'HTTP://WWW.') || '#again'"
    none = "NULL::VARCHAR"
    # number, url, seconds later, kind, etag, modified, cache, length, payload
    made = [
        (0, "url", 0, "response", "md5(html)", none, none, "octet_length(encode(html))::VARCHAR", "html"),
        (1, again, 90_000, "revisit", """'W/"' || md5(html) || '"'""", none, "'max-age=' || page_id % 7", none, none),
        (2, "url", 0, "revisit", "md5(html)", none, "'max-age=1'", none, none),
        (3, "url", 60, "revisit", "'stale-' || page_id", none, "'max-age=2'", none, none),
        (4, "url", 93_600, "response", none, none, none, none, "html || '<!-- again -->'"),
        (5, again, 108_000, "revisit", "md5(html)", none, "'max-age=' || page_id % 7", none, none),
        (6, "url", 180_000, "response", none, "'day ' || page_id % 28", none, none, "html || '<!-- at last -->'"),
        (7, "url", 190_000, "revisit", none, "'day ' || page_id % 14", "'max-age=3'", none, none)]
    rows = " UNION ALL ".join(
        f"SELECT 8 * page_id + {n} AS record_id, {url} AS url, {when} + {later} AS ts, '{kind}' AS kind, {etag} AS etag, "
        f"{modified} AS modified, {cache} AS cache, {length} AS length, {payload} AS payload FROM pages"
        for n, url, later, kind, etag, modified, cache, length, payload in made)
    listed = ", ".join(f"'{name}=' || {value}" for name, value in (
        ("cache-control", "cache"), ("content-length", "r_length"), ("content-type", "'text/html'"),
        ("etag", "coalesce(etag, r_etag)"), ("last-modified", "coalesce(modified, r_modified)")))
    return f"""
WITH captures AS ({rows}),
keyed AS (SELECT *, {_url_key('url')} AS url_key FROM captures),
responses AS (SELECT url_key, ts, max(record_id) AS response_id FROM keyed WHERE kind = 'response' GROUP BY 1, 2),
met AS (SELECT v.*, r.response_id FROM (FROM keyed WHERE kind = 'revisit') v ASOF LEFT JOIN responses r
        ON v.url_key = r.url_key AND v.ts > r.ts),
joined AS (SELECT m.* EXCLUDE (payload, length), r.etag AS r_etag, r.modified AS r_modified, r.length AS r_length, r.payload,
                  coalesce(regexp_replace(m.etag, '^W/|"', '', 'g') = r.etag, m.modified = r.modified) AS agree
           FROM met m LEFT JOIN keyed r ON r.record_id = m.response_id),
told AS (SELECT *, CASE WHEN response_id IS NULL THEN 'no_response' WHEN agree IS NULL THEN 'unchecked'
                        WHEN agree THEN 'resolved' ELSE 'mismatch' END AS outcome FROM joined)
SELECT record_id, ts, url_key, response_id, outcome,
       CASE WHEN outcome IN ('resolved', 'unchecked')
            THEN array_to_string(list_filter([{listed}], lambda x: x IS NOT NULL), ';') END AS headers,
       CASE WHEN outcome IN ('resolved', 'unchecked') THEN md5(payload) END AS payload_md5
FROM told"""


def _finite(vector: str) -> str:
    return f"{vector} IS NOT NULL AND len(list_filter({vector}, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def vector_codes() -> str:
    """The rounds one after the other; a row per vector, part and entry at the widest."""
    parts, entries = codes.PARTS, codes.ENTRIES

    def assigned(number: int, book: str) -> str:
        return f"""
near{number} AS (
    SELECT row, part, min(struct_pack(distance, entry)) AS best FROM (
        SELECT p.row, p.part, b.entry, sum((p.x - b.x) * (p.x - b.x))::bigint AS distance
        FROM places p JOIN {book} b USING (part, place) GROUP BY ALL) GROUP BY row, part)"""

    def moved(number: int, book: str, after: str) -> str:
        return f"""
{after} AS (
    SELECT b.part, b.place, b.entry, coalesce(m.x, b.x) AS x FROM {book} b LEFT JOIN (
        SELECT p.part, p.place, n.best.entry AS entry, floor(sum(p.x)::double / count(*))::bigint AS x
        FROM places p JOIN near{number} n USING (row, part) GROUP BY ALL) m USING (part, place, entry))"""

    steps, book = "", "book0"
    for number in range(codes.ROUNDS):
        steps += assigned(number, book) + "," + moved(number, book, f"book{number + 1}") + ","
        book = f"book{number + 1}"
    return f"""
WITH kept AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding, label) - 1 AS row, *
              FROM embeddings WHERE {_finite('embedding')}),
size AS (SELECT max(len(embedding)) // {parts} AS size FROM kept),
places AS (SELECT row, (i - 1) // size AS part, (i - 1) % size AS place,
                  floor(256 * embedding[i]::double)::bigint AS x
           FROM kept, size, unnest(range(1, size * {parts} + 1)) AS t(i)),
book0 AS (SELECT part, place, row AS entry, x FROM places WHERE row < {entries}),{steps}{assigned(codes.ROUNDS, book)},
coded AS (SELECT row, string_agg(printf('%02x', best.entry), '' ORDER BY part) AS code,
                 sum(best.distance)::bigint AS error FROM near{codes.ROUNDS} GROUP BY row),
errors AS (SELECT label, sum(error)::bigint AS label_error FROM kept JOIN coded USING (row) GROUP BY label),
digest AS (SELECT sha256(string_agg(x::varchar, ',' ORDER BY part, entry, place)) AS codebooks_sha256 FROM {book})
SELECT vec_id, code, error, label_error, codebooks_sha256
FROM kept JOIN coded USING (row) JOIN errors e ON kept.label IS NOT DISTINCT FROM e.label, digest"""


def hard_negatives() -> str:
    """Every anchor against every row."""
    return f"""
WITH kept AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::bigint + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::double)) AS x
    FROM embeddings WHERE label IS NOT NULL AND {_finite('embedding')}),
scores AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
           list_inner_product(a.x, b.x)::bigint AS score
    FROM kept a JOIN kept b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {negatives.POSITIVES}),
ranked AS (
    SELECT anchor_id, positive_id, s.vec_id AS negative_id, positive_score, s.score AS negative_score,
           row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)::integer AS rank
    FROM positives p JOIN scores s USING (anchor_id)
    WHERE NOT same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= {negatives.NEGATIVES}"""


SQL = {"op11_vector_codes": vector_codes(), "op13_hard_negatives": hard_negatives(),
       "op6_license_scan": license_scan(), "op7_warc_revisits": revisit(), "op10_mix_sources": mix()}
