"""DuckDB SQL that must give the rows of the operators, over any relation of documents."""

from __future__ import annotations

from basketry.llm import lexical_search, license_rules, line_dedup, line_quality

# White space, upper and lower case as DuckDB writes them.
_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WORDS = "'[^\\x20\\x09-\\x0D]+'"
_TOKENS = "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'"


def lower(x: str) -> str:
    return f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def words(x: str, pattern: str = _WORDS) -> str:
    return f"regexp_extract_all(coalesce({x}, ''), {pattern})"


def line_dedup_texts(docs: str) -> str:
    """``doc_id, n_lines, n_dropped, kept``."""
    key = lower(f"trim(line, {_SPACE})")
    return f"""
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
           coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '') AS kept
    FROM (SELECT l.*, coalesce(k.n >= {line_dedup.MIN_DOCS} AND length(l.key) >= {line_dedup.MIN_CHARS} AND l.doc_id <> k.keeper, false) AS lost
          FROM (SELECT *, {key} AS key FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                       generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM {docs})) l
          JOIN (SELECT {key} AS key, count(DISTINCT doc_id) AS n, max(doc_id) AS keeper
                FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM {docs}) GROUP BY 1) k ON l.key = k.key)
    GROUP BY doc_id"""


def line_dedup_report(docs: str) -> str:
    return f"SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM ({line_dedup_texts(docs)})"


def quality(docs: str) -> str:
    """The measures, the verdict and the text without frequent lines."""
    space = "'[\\x20\\x09-\\x0D]+'"
    return f"""
    SELECT d.doc_id, d.n_words, d.word_chars, d.n_symbols, coalesce(l.n_dup_lines, 0) AS n_dup_lines, coalesce(r.n_repeat_words, 0) AS n_repeat_words,
           d.n_words < {line_quality.MIN_WORDS} OR 100 * coalesce(r.n_repeat_words, 0) > 50 * d.n_words AS base_failed,
           NOT (d.n_words < {line_quality.MIN_WORDS} OR 100 * coalesce(r.n_repeat_words, 0) > 50 * d.n_words
                OR d.n_words - coalesce(l.n_cut_words, 0) < {line_quality.MIN_LEFT} * d.n_words) AS kept,
           coalesce(l.n_cut_words, 0) AS n_cut_words, l.left_text
    FROM (SELECT doc_id, len({words('text')}) AS n_words, coalesce(list_sum(list_transform({words('text')}, lambda x: length(x))), 0)::BIGINT AS word_chars,
                 len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')) AS n_symbols FROM {docs}) d
    LEFT JOIN (
      SELECT doc_id, count(DISTINCT pos) AS n_repeat_words FROM (
        SELECT doc_id, unnest([pos, pos + 1, pos + 2]) AS pos FROM (
          SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM (
            SELECT doc_id, pos, array_to_string(w[pos:pos + 2], ' ') AS gram FROM (
              SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS pos FROM (SELECT doc_id, {words('text')} AS w FROM {docs})))) WHERE n > 1)
      GROUP BY doc_id) r ON d.doc_id = r.doc_id
    LEFT JOIN (
      SELECT doc_id, count(*) FILTER (has_word) - count(DISTINCT line) FILTER (has_word) AS n_dup_lines,
             sum(CASE WHEN often THEN len({words('line')}) ELSE 0 END)::BIGINT AS n_cut_words,
             coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT often), '') AS left_text
      FROM (SELECT x.*, x.key <> '' AND coalesce(f.n >= {line_quality.MIN_DOCS} AND f.n > least({line_quality.SHARE} * h.n, {line_quality.MAX_DOCS}), false) AS often
            FROM (SELECT *, line <> '' AND len({words('line')}) > 0 AS has_word,
                         trim(regexp_replace({lower('line')}, {space}, ' ', 'g'), ' ') AS key
                  FROM (SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM {docs})) x
            LEFT JOIN (SELECT source, trim(regexp_replace({lower('line')}, {space}, ' ', 'g'), ' ') AS key, count(DISTINCT text) AS n
                       FROM (SELECT source, coalesce(text, '') AS text, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM {docs}) GROUP BY ALL) f
              ON x.key = f.key AND x.source IS NOT DISTINCT FROM f.source
            LEFT JOIN (SELECT source, count(DISTINCT coalesce(text, '')) AS n FROM {docs} GROUP BY source) h ON x.source IS NOT DISTINCT FROM h.source)
      GROUP BY doc_id) l ON d.doc_id = l.doc_id"""


def quality_report(docs: str) -> str:
    return f"SELECT * EXCLUDE (left_text) FROM ({quality(docs)})"


def contamination(docs: str) -> str:
    """Exact windows of 13 words, or of a whole shorter item, against every document."""
    return f"""
    WITH d AS (SELECT doc_id, {words(lower('text'), _TOKENS)} AS w FROM {docs}),
    i AS (SELECT item_id, {words(lower('text'), _TOKENS)} AS w FROM benchmark),
    g AS (SELECT DISTINCT item_id, least(13, len(w)) AS k, array_to_string(w[pos:pos + least(13, len(w)) - 1], ' ') AS gram
          FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS pos FROM i WHERE len(w) > 0)),
    o AS (SELECT doc_id, pos, k, array_to_string(w[pos:pos + k - 1], ' ') AS gram
          FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS pos FROM d, (SELECT DISTINCT k FROM g))),
    m AS (SELECT o.doc_id, o.pos, o.k, g.item_id FROM o JOIN g ON o.k = g.k AND o.gram = g.gram),
    h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + k)) AS p FROM m) GROUP BY doc_id),
    s AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM m) GROUP BY doc_id)
    SELECT d.doc_id, len(d.w) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(s.n_items, 0) AS n_items, sha256(coalesce(s.items, '')) AS items_sha256,
           coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.w) AS contaminated
    FROM d LEFT JOIN h ON d.doc_id = h.doc_id LEFT JOIN s ON d.doc_id = s.doc_id"""


def mix(docs: str) -> str:
    """The level of targets by the sources in order of room; the cut by prefix sums in key order."""
    return f"""
    WITH d AS (SELECT doc_id, source, len({words('text')}) AS size, md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS key, text FROM {docs}),
    s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
    w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM s),
    f AS (SELECT *, sum(source_size) OVER () AS total, coalesce(sum(source_size) OVER (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
                 sum(weight) OVER (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM w),
    v AS (SELECT max((total - 3 * below)::DOUBLE / rest) AS level FROM f WHERE (total - 3 * below)::DOUBLE / rest * weight <= 3 * source_size),
    t AS (SELECT source, source_size, least(level * weight, (3 * source_size)::DOUBLE) AS target FROM w, v),
    p AS (SELECT d.doc_id, d.source, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN round(t.target)::BIGINT // t.source_size ELSE 0 END AS epochs, round(t.target)::BIGINT AS budget,
                 coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size, d.text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
          FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, source, size, source_size, target, (epochs * size + least(greatest(budget - epochs * source_size - before, 0), size))::BIGINT AS taken FROM p"""


def mix_report(docs: str) -> str:
    return f"SELECT * EXCLUDE (source) FROM ({mix(docs)})"


def repeats(docs: str) -> str:
    """Windows of 50 words by their text, the least document of each."""
    return f"""
    WITH d AS (SELECT doc_id, {words('text')} AS w FROM {docs}),
    g AS (SELECT doc_id, pos, hash(array_to_string(w[pos:pos + 49], ' ')) AS h, md5(array_to_string(w[pos:pos + 49], ' ')) AS gram
          FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS pos FROM d WHERE len(w) >= 50)),
    f AS (SELECT h, gram, min(doc_id) AS first FROM g GROUP BY h, gram),
    r AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 50)) AS pos FROM g JOIN f ON g.h = f.h AND g.gram = f.gram WHERE doc_id > first),
    x AS (SELECT doc_id, list(pos) AS gone FROM r GROUP BY doc_id)
    SELECT d.doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed, sha256(CASE WHEN gone IS NULL THEN array_to_string(w, ' ') ELSE
           coalesce((SELECT string_agg(w[i], ' ' ORDER BY i) FROM (SELECT unnest(range(1, len(w) + 1)) AS i) WHERE NOT list_contains(gone, i)), '') END) AS kept_sha256
    FROM d LEFT JOIN x ON d.doc_id = x.doc_id"""


def near_duplicates(docs: str, k: int = 3, percent: int = 90) -> str:
    """All pairs that share an n-gram, their overlap, and the components of the links."""
    return f"""
    WITH RECURSIVE d AS (SELECT doc_id, {words(lower('text'))} AS w FROM {docs}),
    g AS (SELECT DISTINCT doc_id, array_to_string(w[pos:pos + {k - 1}], ' ') AS gram
          FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {k - 1}, 1) + 1)) AS pos FROM d WHERE len(w) > 0)),
    n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
    p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL),
    l AS (SELECT x, y FROM p JOIN n a ON x = a.doc_id JOIN n b ON y = b.doc_id WHERE 100 * o >= {percent} * (a.n + b.n - o)),
    r AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x)
    SELECT d.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(r.y) AS component_id FROM d JOIN r ON d.doc_id = r.x LEFT JOIN n ON d.doc_id = n.doc_id GROUP BY d.doc_id"""


def near_duplicate_links(docs: str) -> str:
    """The components, and the number of links of each document."""
    return f"""
    SELECT c.*, coalesce(k.n_links, 0)::BIGINT AS n_links FROM ({near_duplicates(docs)}) c LEFT JOIN (
      WITH d AS (SELECT doc_id, {words(lower('text'))} AS w FROM {docs}),
      g AS (SELECT DISTINCT doc_id, array_to_string(w[pos:pos + 2], ' ') AS gram
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS pos FROM d WHERE len(w) > 0)),
      n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
      p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL)
      SELECT x AS doc_id, count(*) AS n_links FROM p JOIN n a ON x = a.doc_id JOIN n b ON y = b.doc_id WHERE 100 * o >= 90 * (a.n + b.n - o) GROUP BY x) k
    ON c.doc_id = k.doc_id"""


def pipeline(k: int, percent: int) -> str:
    """The stages one after another, each over what its predecessor kept."""
    return f"""
    WITH RECURSIVE s0 AS (SELECT doc_id, text, source FROM documents),
    q AS MATERIALIZED (SELECT * FROM ({quality("s0")})),
    s1 AS MATERIALIZED (SELECT s0.doc_id, q.left_text AS text, s0.source FROM s0 JOIN q ON s0.doc_id = q.doc_id WHERE q.kept),
    t AS MATERIALIZED (SELECT * FROM ({line_dedup_texts("s1")})),
    s2 AS MATERIALIZED (SELECT s1.doc_id, t.kept AS text, s1.source FROM s1 JOIN t ON s1.doc_id = t.doc_id),
    n AS MATERIALIZED (SELECT * FROM ({near_duplicates("s2", k, percent)})),
    s3 AS MATERIALIZED (SELECT s2.* FROM s2 JOIN n ON s2.doc_id = n.doc_id WHERE n.component_id = s2.doc_id),
    c AS MATERIALIZED (SELECT * FROM ({contamination("s3")})),
    s4 AS MATERIALIZED (SELECT s3.* FROM s3 JOIN c ON s3.doc_id = c.doc_id WHERE NOT c.contaminated)
    SELECT * FROM ({mix_report("s4")})"""


def license_report(docs: str) -> str:
    """Every rule over words that are two spaces apart, each with a space of its own around it."""

    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    def spaced(pattern: str) -> str:
        return " (?:" + pattern.replace(" ?", "\0").replace(" ", "  ").replace("\0", "(  )?") + ") "

    rules = ", ".join(
        f"({r.number}, {license_rules.LEVELS[r.kind]}, {license_rules.WEIGHTS[r.kind]}::DOUBLE, {quoted(r.label)}, {str(r.base).lower()}, {quoted(f' {r.keyword} ')}, {quoted(spaced(r.pattern))})"
        for r in license_rules.RULES
    )
    n_words = "len(regexp_extract_all({}, '[^ ]+'))".format
    return f"""
    WITH d AS (SELECT doc_id, n_words, ' ' || array_to_string(w, '  ') || ' ' AS s
               FROM (SELECT doc_id, w, len(w) AS n_words FROM (SELECT doc_id, {words(lower('text'), _TOKENS)} AS w FROM {docs}))),
    r(no, level, weight, label, base, keyword, pattern) AS (VALUES {rules}),
    m AS (SELECT doc_id, no, level, weight, label, base, regexp_extract_all(s, pattern) AS hits, regexp_split_to_array(s, pattern) AS parts
          FROM d JOIN r ON contains(s, keyword) WHERE regexp_matches(s, pattern)),
    e AS (SELECT doc_id, no, level, weight, label, base, {n_words('hits[k]')} AS size,
                 (list_sum(list_transform(parts[1:k], lambda x: {n_words('x')})) + coalesce(list_sum(list_transform(hits[1:k - 1], lambda x: {n_words('x')})), 0))::BIGINT AS lo
          FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS k FROM m)),
    f AS (SELECT e.*, EXISTS (SELECT 1 FROM e o WHERE o.doc_id = e.doc_id AND o.lo <= e.lo AND o.lo + o.size >= e.lo + e.size
                              AND (o.level < e.level OR o.level = e.level AND (o.size > e.size OR o.size = e.size AND o.no < e.no))) AS lost FROM e)
    SELECT d.doc_id, n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
           coalesce(labels, '') AS labels, coalesce(score, 0) AS score
    FROM d LEFT JOIN (
      SELECT doc_id, count(*) FILTER (base) AS n_base, min(lo) FILTER (base) AS first_word, max(lo) FILTER (base) AS last_word,
             string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
             string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base OR NOT lost) AS labels, max(weight) FILTER (base OR NOT lost) AS score
      FROM f GROUP BY doc_id) x ON d.doc_id = x.doc_id"""


def periodic_report(docs: str) -> str:
    """Pairs of equal words up to a quarter of the text apart, gathered to stretches."""
    crc = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
             lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)), lambda c, k: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END))))"""
    return f"""
    WITH s AS (SELECT doc_id, w, len(w)::BIGINT AS n, h, h // 10 AS g FROM (SELECT doc_id, {words('text')} AS w, {crc} AS h FROM {docs})),
    a AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a, CASE WHEN h % 10 = 0 AND n > 0 THEN 1 + (n - g % n) // (3 + g % 8) END AS p FROM s),
    d AS (SELECT doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) END AS w FROM a),
    x AS (SELECT doc_id, n, unnest(w) AS word, unnest(range(n)) AS i FROM d WHERE n >= 6),
    y AS (SELECT x.doc_id, z.i - x.i AS q, x.i FROM x JOIN x z ON x.doc_id = z.doc_id AND x.word = z.word AND z.i > x.i AND 4 * (z.i - x.i) <= x.n),
    t AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM y)
          GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
    r AS (SELECT doc_id, start, length, min(q) AS period FROM t GROUP BY ALL),
    c AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM (SELECT doc_id, unnest(w) AS word, unnest(range(n)) AS i FROM d) v
          WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.doc_id = v.doc_id AND v.i >= r.start + r.period AND v.i < r.start + r.length) GROUP BY doc_id),
    b AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed,
                 max(ROW(length, -start, -period)) AS longest FROM r GROUP BY doc_id)
    SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, (-longest[2])::BIGINT AS start, longest[1]::BIGINT AS length, (-longest[3])::BIGINT AS period,
           (1000 * longest[1] // -longest[3])::BIGINT AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
    FROM d LEFT JOIN b ON d.doc_id = b.doc_id LEFT JOIN c ON d.doc_id = c.doc_id"""


def search_report(docs: str, items: str) -> str:
    x = lexical_search
    term = "'" + x.TERM + "'"
    return f"""
    WITH t AS (SELECT doc_id, unnest({words(lower('text'), term)}) AS term FROM {docs}),
    f AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
    g AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM f GROUP BY doc_id),
    c AS (SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS big_l FROM g),
    m AS (SELECT doc_id, {x.FLOOR} + ({x.SLOPE} * n * big_n) // big_l AS m FROM g, c),
    q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({words(lower('text'), term)}) AS term FROM {items}) GROUP BY ALL),
    w AS (SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM f, c WHERE term IN (SELECT term FROM q) GROUP BY term, big_n),
    s AS (SELECT item_id, doc_id, sum(times * w * (({x.SCALE}::BIGINT * tf) // ({x.TF} * tf + {x.NORM} * m)))::BIGINT AS score
          FROM q JOIN w USING (term) JOIN f USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id)
    SELECT item_id, rank::INT AS rank, doc_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= {x.BEST}"""
