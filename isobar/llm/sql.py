"""SQL for queries of this folder, written from what they return rather than from how the operators work."""

#: crc32 needs its table (one entry for each byte) and a list of bytes.
CRC_TABLE = """SELECT list(list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS entries
    FROM (SELECT unnest(range(256)) AS b)"""


def crc32(text: str) -> str:
    """Expression; the column ``entries`` must be in reach."""
    octets = f"list_transform(range(1, 2 * strlen({text}), 2), lambda i: ('0x' || substr(hex(encode({text})), i, 2))::BIGINT)"
    step = "lambda c, b: xor(c >> 8, entries[xor(c, b) % 256 + 1])"
    return f"xor(list_reduce(list_concat([4294967295], {octets}), {step}), 4294967295)"


def merkle(fields: list[str], fan: int = 16) -> str:
    part = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    leaf = " || ".join(part.format(f) for f in fields)
    tampered = " || ".join(part.format(lower if f == "text" else f) for f in fields)

    def tree(name: str, nodes: str) -> str:
        return f"""{name} AS (
    {nodes}
    UNION ALL
    SELECT tree, level + 1, i // {fan}, sha256(string_agg(h, '' ORDER BY i)), (n + {fan - 1}) // {fan}
    FROM {name} WHERE n > 1 GROUP BY tree, level, i // {fan}, n
),
{name}_runs AS (
    SELECT tree, level, i // {fan} AS run, list(h ORDER BY i) AS hs FROM {name} WHERE n > 1 GROUP BY ALL
)"""

    def steps(name: str, tree_of: str, place: str, offset: int) -> str:
        slot = f"(({place} >> (4 * r.level)) % {fan})"
        return f"""SELECT l.row_id, r.level + {offset} AS level,
        array_to_string(r.hs[1 : {slot}], '') AS b, array_to_string(r.hs[{slot} + 2 :], '') AS a
    FROM placed l JOIN ranked_sources s ON l.source IS NOT DISTINCT FROM s.source
    JOIN {name}_runs r ON r.tree = {tree_of} AND r.run = {place} >> (4 * (r.level + 1))"""

    return f"""
WITH RECURSIVE crc AS ({CRC_TABLE}),
ranked_sources AS (
    SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, count(*) OVER () AS n_sources
    FROM (SELECT DISTINCT source FROM documents)
),
leaves AS (
    SELECT doc_id, source, sha256({leaf}) AS leaf,
        CASE WHEN {crc32("doc_id::VARCHAR")} % 5 = 0 THEN sha256({tampered}) END AS tampered
    FROM documents, crc
),
placed AS (
    SELECT *, row_number() OVER () AS row_id,
        row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
        count(*) OVER (PARTITION BY source) AS n
    FROM leaves
),
{tree("low", "SELECT tree, 0 AS level, i, leaf AS h, n FROM placed JOIN ranked_sources s ON placed.source IS NOT DISTINCT FROM s.source")},
{tree("high", "SELECT 0 AS tree, 0 AS level, tree AS i, h, n_sources AS n FROM low JOIN ranked_sources USING (tree) WHERE n = 1")},
steps AS (
    {steps("low", "s.tree", "l.i", 0)}
    UNION ALL
    {steps("high", "0", "s.tree", 100)}
),
paths AS (SELECT row_id, list({{'b': b, 'h': '', 'a': a}} ORDER BY level) AS steps FROM steps GROUP BY row_id),
checked AS (
    SELECT l.doc_id, l.leaf, low.h AS subroot, high.h AS root, coalesce(steps, []) AS steps,
        list_reduce(list_concat([{{'b': '', 'h': coalesce(tampered, leaf), 'a': ''}}], coalesce(steps, [])),
            lambda x, y: {{'b': '', 'h': sha256(y.b || x.h || y.a), 'a': ''}}).h AS folded_root
    FROM placed l JOIN ranked_sources s ON l.source IS NOT DISTINCT FROM s.source
    JOIN low ON low.tree = s.tree AND low.n = 1 JOIN high ON high.n = 1 LEFT JOIN paths USING (row_id)
)
SELECT doc_id, leaf, subroot, root,
    sha256(array_to_string(list_transform(steps, lambda s: s.b || s.a), '')) AS proof_sha256,
    folded_root, folded_root = root AS verified
FROM checked"""


def spelling(least_length: int = 7, least_n: int = 2, slip: int = 31, ratio: int = 10) -> str:
    """Near words by what is left when one letter goes: equal rests of one place, or a rest that is a word."""
    return f"""
WITH RECURSIVE crc AS ({CRC_TABLE}),
runs AS (
    SELECT doc_id, run, count(*) AS n FROM (
        SELECT doc_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
        FROM documents
    ) WHERE length(run) >= {least_length} GROUP BY ALL
),
hashed AS (SELECT run, n, {crc32("(doc_id::VARCHAR || ':' || run)")} AS h FROM runs, crc),
slipped AS (
    SELECT n, CASE WHEN h % {slip} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
        ELSE run END AS word
    FROM hashed
),
words AS (
    SELECT word, sum(n)::BIGINT AS n FROM slipped WHERE length(word) >= {least_length}
    GROUP BY word HAVING sum(n) >= {least_n}
),
rests AS (
    SELECT word, n, k, substr(word, 1, k) || substr(word, k + 2) AS rest
    FROM (SELECT word, n, unnest(range(length(word))) AS k FROM words)
),
inserted AS (SELECT r.word AS long, w.word AS short, r.n AS long_n, w.n AS short_n FROM rests r JOIN words w ON r.rest = w.word),
near AS (
    SELECT a.word, b.word AS other, b.n AS other_n FROM rests a JOIN rests b USING (k, rest) WHERE a.word <> b.word
    UNION SELECT long, short, short_n FROM inserted
    UNION SELECT short, long, long_n FROM inserted
),
best AS (
    SELECT *, count(*) OVER (PARTITION BY word) AS n_near,
        row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS place
    FROM near
),
formed AS (
    SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near,
        CASE WHEN b.other_n >= {ratio} * w.n THEN b.other END AS form,
        CASE WHEN b.other_n >= {ratio} * w.n THEN b.other_n END AS form_n
    FROM words w LEFT JOIN best b ON w.word = b.word AND b.place = 1
),
chains AS (
    SELECT word, word AS root FROM formed
    UNION ALL SELECT c.word, f.form FROM chains c JOIN formed f ON f.word = c.root WHERE f.form IS NOT NULL
),
ends AS (SELECT c.word, c.root FROM chains c JOIN formed f ON f.word = c.root WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)"""
