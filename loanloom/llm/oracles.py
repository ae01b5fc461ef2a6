"""DuckDB SQL for the queries of this folder that SQL can express."""

from __future__ import annotations

from loanloom.llm import line_cleaning as lines


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _class(characters: str) -> str:
    """A class of characters, each behind a backslash unless it is a letter of a script."""
    return "[" + "".join(f"\\{c}" if c.isascii() else c for c in characters) + "]"


def _without(column: str, characters: str) -> str:
    return f"regexp_replace({column}, {_quoted(_class(characters))}, '', 'g')"


_LINE_CLEANING = f"""
    WITH texts AS (
      SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents
    ), split AS (
      SELECT row_id, unnest(string_split(text, chr(10))) AS line,
        generate_subscripts(string_split(text, chr(10)), 1) AS nth
      FROM texts
    ), worded AS (
      SELECT *, regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+') AS words FROM split
    ), listed AS (
      SELECT *, len(words) AS n, length(array_to_string(words, '')) AS chars,
        length(line) - length({_without("line", lines.PUNCTUATION)}) AS marks,
        length(line) - length({_without("line", lines.SEPARATORS)}) AS bars,
        lead(words[1]) OVER (PARTITION BY row_id ORDER BY nth) AS following,
        row_number() OVER (PARTITION BY row_id, line ORDER BY nth) > 1 AS again
      FROM worded WHERE len(words) > 0
    ), judged AS (
      SELECT *, CASE
        WHEN bars >= {lines.BARS} AND n <= {lines.WORDS_TO_A_BAR} * bars THEN 'n'
        WHEN n <= {lines.MENU_WORDS} AND chars > marks AND len(list_filter(words,
          lambda w: NOT list_contains(['', {", ".join(_quoted(w) for w in sorted(lines.MENU))}],
          lower({_without("w", lines.PUNCTUATION)})))) = 0 THEN 'n'
        WHEN n <= {lines.NOTICE_WORDS} AND (
          {" OR ".join(f"contains(lower(line), {_quoted(p)})" for p in lines.PHRASES)}) THEN 'b'
        WHEN marks >= {lines.MARKS} AND 5 * marks > chars THEN 'p'
        WHEN regexp_matches(line, {_quoted(_class(lines.ENDS) + _class(lines.CLOSERS) + "*")}
            || '[\\x20\\x09-\\x0D]*$') THEN ''
        WHEN n >= {lines.CONTINUED} AND regexp_matches(coalesce(following, ''), '^\\p{{Ll}}') THEN ''
        ELSE 'p' END AS fault
      FROM listed
    ), by_lines AS (
      SELECT row_id, count_if(again) AS n_dup_lines, count_if(fault = 'p') AS n_punctuation,
        count_if(fault = 'n') AS n_navigation, count_if(fault = 'b') AS n_boilerplate,
        coalesce(sum(chars) FILTER (fault <> ''), 0)::BIGINT AS lost_chars
      FROM judged GROUP BY row_id
    ), whole AS (
      SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words FROM texts
    ), windows AS (
      SELECT row_id, unnest(range(1, len(words) - 6)) AS first,
        unnest(list_transform(range(1, len(words) - 6),
          lambda i: array_to_string(words[i:i + {lines.WINDOW - 1}], ' '))) AS words
      FROM whole WHERE len(words) > {lines.WINDOW}
    ), named AS (
      SELECT row_id, first, count(*) OVER (PARTITION BY row_id, words) AS times FROM windows
    ), covered AS (
      SELECT row_id, count(DISTINCT first + k) AS n_repeat_words
      FROM named, range({lines.WINDOW}) AS r(k) WHERE times > 1 GROUP BY row_id
    ), counted AS (
      SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
        length(text) - length({_without("text", lines.SYMBOLS)}) AS n_symbols,
        coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
        coalesce(n_punctuation, 0) AS n_punctuation, coalesce(n_navigation, 0) AS n_navigation,
        coalesce(n_boilerplate, 0) AS n_boilerplate, coalesce(lost_chars, 0) AS lost_chars
      FROM whole LEFT JOIN by_lines USING (row_id) LEFT JOIN covered USING (row_id)
    )
    SELECT *, n_words < {lines.LEAST_WORDS}
        OR 100 * n_repeat_words > {lines.MOST_REPEATED} * n_words AS base_failed,
      NOT base_failed AND 10 * lost_chars <= {lines.MOST_LOST} * word_chars AS kept
    FROM counted
"""

SQL: dict[str, str] = {
    "op2_warc": """
        WITH rows AS (
          SELECT page_id, coalesce(html, '') AS payload FROM pages
        ), sized AS (
          SELECT page_id, strlen(payload) AS payload_bytes, sha256(payload) AS payload_digest
          FROM rows
        ), firsts AS (
          SELECT payload_digest, min(page_id) AS first_id FROM sized
          WHERE payload_bytes >= 100 GROUP BY payload_digest
        )
        SELECT page_id, payload_bytes, payload_digest,
          CASE WHEN first_id < page_id THEN 'revisit' ELSE 'response' END AS record_type,
          CASE WHEN first_id < page_id THEN first_id END AS refers_to
        FROM sized LEFT JOIN firsts USING (payload_digest)
    """,
    "op4_url_trie": """
        WITH parts AS (
          SELECT page_id,
            CASE WHEN contains(coalesce(url, ''), '://')
              THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
          FROM pages
        ), cut AS (
          SELECT page_id, regexp_extract(rest, '^[^?#]*') AS rest FROM parts
        ), split AS (
          SELECT page_id, translate(regexp_extract(rest, '^[^/]*'),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            CASE WHEN contains(rest, '/') THEN substr(rest, strpos(rest, '/')) ELSE '' END AS path
          FROM cut
        ), rules(verdict, rule_host, rule_path) AS (
          VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
            ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
        ), fits AS (
          SELECT page_id, rule_host || rule_path AS rule, verdict,
            row_number() OVER (PARTITION BY page_id
              ORDER BY length(rule_host || rule_path) DESC, verdict DESC) AS nth
          FROM split JOIN rules
            ON (host = rule_host OR ends_with(host, '.' || rule_host))
            AND starts_with(path, rule_path)
        )
        SELECT s.page_id, s.host, s.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
        FROM split s LEFT JOIN fits f ON f.page_id = s.page_id AND f.nth = 1
    """,
    "op6_grace": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
          doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op12_line_cleaning": _LINE_CLEANING,
    # Text columns enter with their bytes in UTF-8. CRC-32 is reduced over a list of
    # steps: take in a byte (its value), or shift out a bit (-1).
    "op13_merkle_manifest": """
        WITH RECURSIVE ids AS (
          SELECT doc_id, lang, n_chars,
            coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-')
              || coalesce(strlen(source) || ':' || source, '-')
              || coalesce(strlen(lang) || ':' || lang, '-') AS front,
            coalesce(strlen(text) || ':' || text, '-') AS back,
            xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
              string_split(doc_id::VARCHAR, ''),
              lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
              lambda c, x: CASE WHEN x >= 0 THEN xor(c, x)
                ELSE xor(c >> 1, 3988292384 * (c & 1)) END)) AS code
          FROM documents
        ), hashed AS (
          SELECT doc_id, lang,
            sha256(front || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || back) AS leaf,
            CASE WHEN code % 7 = 0 THEN sha256(front
                || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || back)
              ELSE sha256(front || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || back)
            END AS shown
          FROM ids
        ), leaves AS (
          SELECT *, row_number() OVER () AS row_id, count(*) OVER (PARTITION BY lang) AS n,
            row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, shown) - 1 AS pos
          FROM hashed
        ), tree AS (
          SELECT 0 AS level, lang, pos, n, leaf AS digest FROM leaves
          UNION ALL
          SELECT level + 1, lang, pos // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos))
          FROM tree WHERE n > 1 GROUP BY level, lang, pos // 2, (n + 1) // 2
        ), subroots AS (
          SELECT lang, digest, count(*) OVER () AS n,
            row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos
          FROM tree WHERE n = 1
        ), top AS (
          SELECT 0 AS level, pos, n, digest FROM subroots
          UNION ALL
          SELECT level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos))
          FROM top WHERE n > 1 GROUP BY level, pos // 2, (n + 1) // 2
        ), climb AS (
          SELECT row_id, 0 AS level, lang, pos, n, '' AS others, shown AS folded FROM leaves
          UNION ALL
          SELECT c.row_id, c.level + 1, c.lang, c.pos // 2, (c.n + 1) // 2,
            c.others || coalesce(t.digest, ''),
            sha256(CASE WHEN c.pos % 2 = 0 THEN c.folded || coalesce(t.digest, '')
              ELSE t.digest || c.folded END)
          FROM climb c LEFT JOIN tree t ON t.level = c.level
            AND t.lang IS NOT DISTINCT FROM c.lang AND t.pos = xor(c.pos, 1)
          WHERE c.n > 1
        ), over_groups AS (
          SELECT c.row_id, 0 AS level, s.pos, s.n, c.others, c.folded
          FROM climb c JOIN subroots s ON s.lang IS NOT DISTINCT FROM c.lang WHERE c.n = 1
          UNION ALL
          SELECT c.row_id, c.level + 1, c.pos // 2, (c.n + 1) // 2,
            c.others || coalesce(t.digest, ''),
            sha256(CASE WHEN c.pos % 2 = 0 THEN c.folded || coalesce(t.digest, '')
              ELSE t.digest || c.folded END)
          FROM over_groups c LEFT JOIN top t ON t.level = c.level AND t.pos = xor(c.pos, 1)
          WHERE c.n > 1
        )
        SELECT l.doc_id, l.leaf, s.digest AS subroot, r.digest AS root,
          sha256(o.others) AS proof_sha256, o.folded AS folded_root,
          o.folded = r.digest AS verified
        FROM leaves l
        JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang
        JOIN over_groups o ON o.row_id = l.row_id AND o.n = 1
        CROSS JOIN (SELECT digest FROM top WHERE n = 1) r
    """,
}
