"""DuckDB SQL of queries whose text is long or built from parts."""

from __future__ import annotations


def crc32(text: str) -> str:
    """CRC-32 of an ASCII string, bit by bit (reflected polynomial EDB88320)."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda c: [ord(c), 0, 0, 0, 0, 0, 0, 0]))"
    mixed = f"list_reduce(list_concat([4294967295], {steps}), lambda x, y: xor(xor(x, y) >> 1, 3988292384 * (xor(x, y) & 1)))"
    return f"xor({mixed}::BIGINT, 4294967295)"


LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

PERIODIC_RUNS = rf"""
    WITH texts AS (
        SELECT doc_id, {crc32("doc_id::VARCHAR")} AS h, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
        FROM documents
    ), sized AS (
        SELECT *, len(words) AS n, h % 10 = 0 AND len(words) > 0 AS echoed, (h // 10) % greatest(len(words), 1) AS a FROM texts
    ), periods AS (
        SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM sized
    ), told AS (
        SELECT doc_id, n, unnest(range(n)) AS i, unnest(CASE WHEN echoed THEN list_transform(
                   range(n), lambda i: CASE WHEN i < a THEN words[i + 1] ELSE words[a + (i - a) % p + 1] END) ELSE words END) AS word
        FROM periods
    ), pairs AS (
        SELECT doc_id, n, i, word, lead(word) OVER (PARTITION BY doc_id ORDER BY i) AS following FROM told
    ), met AS (
        SELECT b.doc_id, b.i, b.i - a.i AS lag
        FROM pairs a JOIN pairs b ON a.doc_id = b.doc_id AND a.word = b.word AND a.following = b.following AND a.i < b.i
        WHERE 4 * (b.i - a.i) <= b.n
    ), numbered AS (
        SELECT *, i - row_number() OVER (PARTITION BY doc_id, lag ORDER BY i) AS island FROM met
    ), stretches AS (
        SELECT doc_id, min(i) - lag AS start, count(*) + 1 + lag AS length, lag AS period FROM numbered GROUP BY doc_id, lag, island
    ), runs AS (
        SELECT doc_id, start, length, min(period) AS period FROM stretches
        WHERE length >= greatest(6, 4 * period) GROUP BY doc_id, start, length
    ), best AS (
        SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length / period DESC, start, period) AS nth FROM runs
    ), listed AS (
        SELECT doc_id, count(*) AS n_runs,
               sha256(string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period)) AS runs_sha256
        FROM runs GROUP BY doc_id
    ), dropped AS (
        SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs
    ), kept AS (
        SELECT doc_id, sha256(string_agg(word, ' ' ORDER BY i)) AS collapsed_sha256
        FROM told ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id
    )
    SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length, period::BIGINT AS period,
           (1000 * length // period)::BIGINT AS exponent_milli, coalesce(runs_sha256, sha256('')) AS runs_sha256,
           coalesce(collapsed_sha256, sha256('')) AS collapsed_sha256
    FROM texts LEFT JOIN listed USING (doc_id) LEFT JOIN (FROM best WHERE nth = 1) USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


def _merkle(levels: int = 5) -> str:
    """Both trees level by level; ``levels`` of 16 hold a million rows a source and a million sources."""

    def leaf(text: str) -> str:
        fields = [f"coalesce(strlen({x}::VARCHAR) || ':' || {x}, '-')" for x in ("doc_id", "source", "lang", "n_chars", text)]
        return f"sha256({' || '.join(fields)})"

    lowered = LOWERED.format("text")
    parts = [
        f"""leaves AS (
        SELECT doc_id, source, {leaf("text")} AS leaf,
               CASE WHEN {crc32("doc_id::VARCHAR")} % 5 = 0 THEN {leaf(lowered)} END AS tampered FROM documents
    ), a0 AS (
        SELECT *, source AS tree, leaf AS digest, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place
        FROM leaves
    )"""
    ]

    def tree(name: str) -> None:
        for k in range(levels):
            parts.append(f"""{name}_run{k} AS (
        SELECT tree, place // 16 AS place, list(digest ORDER BY place) AS run, sum(count(*)) OVER (PARTITION BY tree) AS n
        FROM {name}{k} GROUP BY tree, place // 16
    ), {name}{k + 1} AS (
        SELECT tree, place, CASE WHEN n = 1 THEN run[1] ELSE sha256(array_to_string(run, '')) END AS digest FROM {name}_run{k}
    )""")

    tree("a")
    parts.append(f"""b0 AS (
        SELECT 0 AS tree, tree AS source, digest, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS place FROM a{levels}
    )""")
    tree("b")
    columns = "doc_id, source, leaf, subroot, root"
    parts.append(f"""climb AS (
        SELECT doc_id, a0.source, leaf, a{levels}.digest AS subroot, b{levels}.digest AS root, a0.tree, a0.place, b0.place AS above,
               coalesce(tampered, leaf) AS folded, '' AS siblings
        FROM a0 JOIN a{levels} ON a0.tree IS NOT DISTINCT FROM a{levels}.tree
        JOIN b0 ON a0.source IS NOT DISTINCT FROM b0.source, b{levels}
    )""")
    before = "climb"
    for name in "ab":
        for k in range(levels):
            step = f"{name}_step{k}"
            own = f"(c.place // {16**k}) % 16"
            left, right = f"array_to_string(run[1:{own}], '')", f"array_to_string(run[{own} + 2:], '')"
            parts.append(f"""{step} AS (
        SELECT {columns}, c.tree, c.place, c.above,
               CASE WHEN n = 1 THEN folded ELSE sha256({left} || folded || {right}) END AS folded,
               CASE WHEN n = 1 THEN siblings ELSE siblings || {left} || {right} END AS siblings
        FROM {before} c JOIN {name}_run{k} r ON c.tree IS NOT DISTINCT FROM r.tree AND c.place // {16 ** (k + 1)} = r.place
    )""")
            before = step
        if name == "a":
            parts.append(f"turned AS (SELECT {columns}, 0 AS tree, above AS place, above, folded, siblings FROM {before})")
            before = "turned"
    return f"""
    WITH {", ".join(parts)}
    SELECT doc_id, leaf, subroot, root, sha256(siblings) AS proof_sha256, folded AS folded_root, folded = root AS verified
    FROM {before}
"""


MERKLE_MANIFEST = _merkle()

WORDS = rf"regexp_extract_all({LOWERED.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = f"""
    WITH docs AS (
        SELECT doc_id, {WORDS} AS words FROM documents
    ), items AS (
        SELECT coalesce(item_id::VARCHAR, '') AS item, {WORDS} AS words FROM benchmark
    ), begins AS (
        SELECT item, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS b FROM items WHERE len(words) > 0
    ), windows AS (
        SELECT DISTINCT item, array_to_string(words[b:b + 9], ' ') AS sought, least(len(words), 10) AS size FROM begins
    ), sizes AS (
        SELECT DISTINCT size FROM windows
    ), places AS (
        SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS b FROM docs, sizes
    ), hits AS (
        SELECT doc_id, b, size, item
        FROM (SELECT doc_id, b, size, array_to_string(words[b:b + size - 1], ' ') AS sought FROM places) JOIN windows USING (sought, size)
    ), words_hit AS (
        SELECT doc_id, count(DISTINCT place) AS n_hit
        FROM (SELECT DISTINCT doc_id, unnest(range(b, b + size)) AS place FROM hits) GROUP BY doc_id
    ), items_hit AS (
        SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
        FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
    )
    SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
           coalesce(items_sha256, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
    FROM docs LEFT JOIN words_hit USING (doc_id) LEFT JOIN items_hit USING (doc_id)
"""
