"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from codonmill.llm import conversation_trie as ct
from codonmill.llm import fill_in_middle as fim
from codonmill.llm import quality_rules as rules

WORD = r"[^\x20\x09-\x0D]+"


def measures_sql(table: str) -> str:
    """Common table expressions up to `judged`, one row per row of `table`."""
    stop_words = sorted({w for words in rules.STOP_WORDS.values() for w in words.split()})
    listed = ", ".join(f"'{w}'" for w in stop_words)
    tests = ["NOT base_failed"]
    for rule in rules.RULES:
        tests += [f"{rule.name} >= {rule.low}"] if rule.low is not None else []
        tests += [f"{rule.name} <= {rule.high}"] if rule.high is not None else []
    return rf"""
    split AS (
        SELECT *, row_number() OVER () AS row_id,
            regexp_extract_all(coalesce(text, ''), '{WORD}') AS words,
            list_filter(string_split(coalesce(text, ''), chr(10)),
                        lambda line: regexp_matches(line, '[^\x20\x09-\x0D]')) AS lines
        FROM {table}
    ),
    windows AS (
        SELECT row_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS run
        FROM (SELECT row_id, words, unnest(range(1, len(words) - 1)) AS i FROM split)
    ),
    repeated AS (
        SELECT row_id, i FROM windows
        QUALIFY count(*) OVER (PARTITION BY row_id, run) > 1
    ),
    covered AS (
        SELECT row_id, count(DISTINCT i + j) AS n_repeat_words
        FROM repeated CROSS JOIN (VALUES (0), (1), (2)) AS step(j)
        GROUP BY row_id
    ),
    counted AS (
        SELECT split.*, len(words) AS n_words,
            length(array_to_string(words, '')) AS word_chars,
            len(regexp_extract_all(coalesce(text, ''), '{rules.SYMBOLS}')) AS n_symbols,
            len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
            coalesce(n_repeat_words, 0) AS n_repeat_words,
            len(list_filter(words, lambda w: w IN ({listed}))) AS n_stop_words
        FROM split LEFT JOIN covered USING (row_id)
    ),
    shares AS (
        SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
            word_chars / greatest(n_words, 1) AS mean_word_chars,
            n_symbols / greatest(word_chars, 1) AS symbol_share,
            n_stop_words / greatest(n_words, 1) AS stop_word_share,
            n_dup_lines / greatest(n_lines, 1) AS dup_line_share,
            n_repeat_words / greatest(n_words, 1) AS repeat_word_share
        FROM counted
    ),
    judged AS (SELECT *, {" AND ".join(tests)} AS kept FROM shares)"""


def quality_rules() -> str:
    return f"""WITH {measures_sql("documents")}
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
        base_failed, kept, n_stop_words, n_lines
    FROM judged"""


def fill_in_middle() -> str:
    unit = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
    drawn = ", ".join(
        f"('0x' || substr(sha256('{fim.SEED}:' || coalesce(doc_id::VARCHAR, '')), {8 * i + 1}, 8))::BIGINT AS h{i + 1}"
        for i in range(4)
    )
    part = lambda low, high: f"array_to_string(units[{low}:{high}], '')"
    return rf"""
    WITH cut AS (
        SELECT doc_id, coalesce(text, '') AS text, {drawn},
            regexp_extract_all(coalesce(text, ''), '{unit}') AS units
        FROM documents
    ),
    placed AS (
        SELECT *, len(units) AS n,
            least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS low,
            greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS high,
            CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                      OR h3 % 100 >= {fim.CHANGED} THEN 'plain'
                 WHEN h4 % 100 < {fim.SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form
        FROM cut
    ),
    parts AS (
        SELECT *, {part(1, "low")} AS prefix, {part("low + 1", "high")} AS middle, {part("high + 1", "n")} AS suffix
        FROM placed
    )
    SELECT doc_id, n, form,
        CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
        CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
        sha256(CASE form WHEN 'plain' THEN text
                         WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                         ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
        sha256(text) AS restored_sha256
    FROM parts"""


def conversation_trie() -> str:
    """Nodes are named by their whole path; descendants are found along each conversation."""
    # A CRC-32 bit by bit.
    crc = (
        "xor(4294967295, list_reduce([4294967295::BIGINT] || "
        "list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT), "
        "lambda so_far, byte: list_reduce([xor(so_far, byte), 0, 0, 0, 0, 0, 0, 0, 0], "
        "lambda bits, i: xor(bits >> 1, (bits & 1) * 3988292384))))"
    )
    return rf"""
    WITH own AS (
        SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
            row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                               coalesce(text, '')) - 1 AS place
        FROM conversations WHERE conv_id IS NOT NULL
    ),
    plan AS (
        SELECT c.*, least(h, coalesce(f.n, 0)) AS m
        FROM (SELECT conv_id, count(*) AS n, {crc} % {ct.HEADS} AS h,
                     conv_id - conv_id % {ct.FAMILY} AS first FROM own GROUP BY conv_id) c
        LEFT JOIN (SELECT conv_id AS first, count(*) AS n FROM own GROUP BY conv_id) f USING (first)
    ),
    turns AS (
        SELECT conv_id, place - h + m AS place, role, text
        FROM own JOIN plan USING (conv_id) WHERE place >= h
        UNION ALL
        SELECT plan.conv_id, own.place, role, text
        FROM plan JOIN own ON own.conv_id = plan.first AND own.place < plan.m
    ),
    paths AS (
        SELECT conv_id, place + 1 AS depth, text,
            string_agg(length(role) || ':' || length(text) || ':' || role || text, '')
                OVER (PARTITION BY conv_id ORDER BY place) AS path
        FROM turns
        UNION ALL
        SELECT conv_id, 0, '', '' FROM plan
    ),
    stops AS (
        SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS ends,
            lag(path) OVER (PARTITION BY conv_id ORDER BY depth) AS parent
        FROM paths
    ),
    nodes AS (
        SELECT path, min(conv_id) AS conv_id, min(depth) AS depth, min(parent) AS parent, count(*) AS n_convs,
            (count(*) - 1) * len(regexp_extract_all(min(text), '{WORD}')) AS saved,
            coalesce(string_agg(CASE WHEN ends THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '') AS ids
        FROM stops GROUP BY path
    ),
    counted AS (
        SELECT nodes.*, coalesce(c.n_children, 0) AS n_children, p.conv_id AS parent_conv_id
        FROM nodes
        LEFT JOIN (SELECT parent AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY parent) c USING (path)
        LEFT JOIN (SELECT path AS parent, conv_id FROM nodes) p ON nodes.parent = p.parent
    ),
    totals AS (
        SELECT above.path, sum((below.n_children = 0)::BIGINT) AS n_leaves, sum(below.saved) AS saved_tokens
        FROM counted below
        JOIN paths above ON above.conv_id = below.conv_id AND above.depth <= below.depth
        GROUP BY above.path
    )
    SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves::BIGINT AS n_leaves,
        saved_tokens::BIGINT AS saved_tokens, sha256(ids) AS ends_sha256
    FROM counted JOIN totals USING (path)"""
