"""SQL that gives the same rows as a registered corpus query, where SQL can express it.

The other queries rest on trained models, sketches, approximate search or a tokenizer, or (repeated passages) take
minutes in SQL on the smallest table; their tests compare them with brute force, round trips and held-out labels.
"""

from __future__ import annotations

from reviewloom.llm import licences

# All pairs of texts with equal shingles, by exact counts; classes are the reachable sets.
NEAR_DUPLICATES = """
WITH RECURSIVE words AS (
  SELECT doc_id, [v FOR v IN string_split_regex(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+') IF v <> ''] AS w FROM documents),
grams AS (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[i:i+4], ' ') FOR i IN range(1, len(w) - 3)] END) AS g FROM words),
bags AS (SELECT doc_id, g, count(*) AS n FROM grams GROUP BY ALL),
sizes AS (SELECT doc_id, CAST(sum(n) AS BIGINT) AS weight FROM bags GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, sum(least(a.n, b.n)) AS s
  FROM bags a JOIN bags b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
firsts AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first FROM documents),
alike AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE CAST(s AS DOUBLE) / (x.weight + y.weight - s) >= 0.8),
linked AS (
  SELECT DISTINCT least(fa.first, fb.first) AS a, greatest(fa.first, fb.first) AS b
  FROM alike JOIN firsts fa ON fa.doc_id = a JOIN firsts fb ON fb.doc_id = b WHERE fa.first <> fb.first),
both_ways AS (SELECT a, b FROM linked UNION SELECT b, a FROM linked),
reach(node, other) AS (
  SELECT first, first FROM firsts
  UNION SELECT reach.node, both_ways.b FROM reach JOIN both_ways ON reach.other = both_ways.a),
roots AS (SELECT node, min(other) AS root FROM reach GROUP BY node)
SELECT doc_id, root AS class_id, doc_id = root AS kept, coalesce(weight, 0) AS weight
FROM firsts JOIN roots ON node = first LEFT JOIN sizes USING (doc_id)
"""

def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def licence_sql() -> str:
    rows = ", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, text in licences.TEMPLATES)
    split = "[v FOR v IN string_split_regex(lower(coalesce(text, '')), '[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') IF v <> '']"

    def runs(key: str, table: str) -> str:
        listed = "CASE WHEN len(w) < 5 THEN [] ELSE [array_to_string(w[i:i+4], ' ') FOR i IN range(1, len(w) - 3)] END"
        return f"SELECT DISTINCT {key}, unnest({listed}) AS g FROM (SELECT {key}, {split} AS w FROM {table})"

    return f"""
WITH templates(template, text) AS (VALUES {rows}),
sought AS ({runs("template", "templates")}),
sizes AS (SELECT template, CAST(count(*) AS INT) AS n_template FROM sought GROUP BY template),
met AS (
  SELECT doc_id, template, CAST(count(*) AS INT) AS n_shared
  FROM ({runs("doc_id", "documents")}) d JOIN sought USING (g) GROUP BY ALL)
SELECT doc_id, template, n_shared, n_template, CAST(n_shared AS DOUBLE) / n_template AS containment
FROM met JOIN sizes USING (template) WHERE CAST(n_shared AS DOUBLE) / n_template >= {licences.CONTAINMENT}
"""


def _crc_table() -> list[int]:
    """The 256 entries of the reflected polynomial's table, by eight halvings of each byte."""
    table = list(range(256))
    for _ in range(8):
        table = [v >> 1 ^ (0xEDB88320 if v & 1 else 0) for v in table]
    return table


def crc32_sql(column: str) -> str:
    """Unsigned crc32 of the UTF-8 bytes of a text, byte by byte."""
    data = f"hex(encode({column}))"
    values = f"[CAST(('0x' || substr({data}, i, 2)) AS BIGINT) FOR i IN range(1, length({data}), 2)]"
    step = f"xor(({_crc_table()}::BIGINT[])[xor(c, b) % 256 + 1], c >> 8)"
    return f"xor(list_reduce({values}, lambda c, b: {step}, CAST(4294967295 AS BIGINT)), 4294967295)"


def spelling_sql() -> str:
    latin = "".join(chr(c) for c in range(0xC0, 0x100))
    # one ASCII character for each letter beyond ASCII, so that edits of bytes are edits of letters
    plain = "".join(chr(c) for c in range(33, 127) if not 97 <= c <= 122)[: len(latin)].replace("'", "''")
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH RECURSIVE found AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z{latin[0]}-{latin[-1]}]+')), '{upper}', '{lower}') AS run
  FROM documents),
counted AS (SELECT doc_id, run, count(*) AS n FROM found WHERE length(run) >= 6 GROUP BY ALL),
summed AS (SELECT *, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS keyed FROM counted),
hashed AS (SELECT run, n, {crc32_sql("keyed")} AS h FROM summed),
results AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word, n
  FROM hashed),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n, translate(word, '{latin}', '{plain}') AS p
  FROM results WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
sized AS (SELECT *, length(word) AS l FROM words),
pairs AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM sized a JOIN sized b ON a.l = b.l WHERE levenshtein(a.p, b.p) = 1
  UNION ALL SELECT a.word, a.n, b.word, b.n FROM sized a JOIN sized b ON a.l = b.l + 1 WHERE levenshtein(a.p, b.p) = 1
  UNION ALL SELECT a.word, a.n, b.word, b.n FROM sized a JOIN sized b ON a.l = b.l - 1 WHERE levenshtein(a.p, b.p) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, encode(other)) AS r, count(*) OVER (PARTITION BY word) AS n_near
  FROM pairs),
formed AS (
  SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near,
    CASE WHEN r.other_n >= 5 * w.n THEN r.other END AS form, CASE WHEN r.other_n >= 5 * w.n THEN r.other_n END AS form_n
  FROM words w LEFT JOIN ranked r ON w.word = r.word AND r.r = 1),
followed AS (
  SELECT word AS start, word AS root, form FROM formed
  UNION ALL SELECT f.start, g.word, g.form FROM followed f JOIN formed g ON f.form = g.word)
SELECT word, formed.form, root, n, n_near, form_n FROM formed JOIN followed ON start = word AND followed.form IS NULL
"""


def merkle_sql() -> str:
    def part(column: str) -> str:
        text = f"CAST({column} AS VARCHAR)"
        return f"coalesce(CAST(strlen({text}) AS VARCHAR) || ':' || {text}, '-')"

    def leaf(text: str) -> str:
        fields = [part(c) for c in ("doc_id", "source", "lang", "n_chars")] + [part(text)]
        return "sha256(" + " || ".join(fields) + ")"

    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    levels = 8
    # levels of the trees by language ("t") and of the tree over them ("s"), all written out
    out = [
        f"""leaves AS (SELECT doc_id, lang, {leaf("text")} AS leaf, {leaf("lowered")} AS changed,
          {crc32_sql("coalesce(CAST(doc_id AS VARCHAR), '')")} AS h
          FROM (SELECT *, translate(text, '{upper}', '{lower}') AS lowered FROM documents))""",
        """t0 AS (SELECT lang AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
          count(*) OVER (PARTITION BY lang) AS n, leaf AS d, doc_id, CASE WHEN h % 3 = 0 THEN changed ELSE leaf END AS f FROM leaves)""",
    ]

    def lifted(name: str, k: int) -> str:
        return f"""{name}{k} AS (SELECT tree, CASE WHEN n > 1 THEN pos // 8 ELSE pos END AS pos, any_value((n + 7) // 8) AS n,
          CASE WHEN any_value(n) > 1 THEN sha256(string_agg(d, '' ORDER BY pos)) ELSE any_value(d) END AS d
          FROM (SELECT tree, pos, n, d FROM {name}{k - 1}) GROUP BY tree, CASE WHEN n > 1 THEN pos // 8 ELSE pos END)"""

    def beside(name: str, k: int) -> str:
        over = "OVER (PARTITION BY tree, pos // 8 ORDER BY pos ROWS BETWEEN"
        return f"""{name}{k}_sides AS (SELECT tree, pos, n,
          coalesce(string_agg(d, '') {over} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
          coalesce(string_agg(d, '') {over} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k})"""

    def folded(name: str, step: str, k: int, source: str) -> str:
        return f"""{step} AS (SELECT p.* REPLACE (
            CASE WHEN s.n > 1 THEN sha256(s.l || p.f || s.r) ELSE p.f END AS f, p.proof || s.l || s.r AS proof,
            CASE WHEN s.n > 1 THEN p.pos // 8 ELSE p.pos END AS pos)
          FROM {source} p JOIN {name}{k}_sides s ON p.tree IS NOT DISTINCT FROM s.tree AND p.pos = s.pos)"""

    out += [lifted("t", k) for k in range(1, levels + 1)] + [beside("t", k) for k in range(levels)]
    out.append(f"s0 AS (SELECT 0 AS tree, row_number() OVER (ORDER BY encode(tree) NULLS FIRST) - 1 AS pos, count(*) OVER () AS n, d, tree AS lang FROM t{levels})")
    out += [lifted("s", k) for k in range(1, levels + 1)] + [beside("s", k) for k in range(levels)]
    out.append("f0 AS (SELECT tree, pos, doc_id, d AS leaf, f, '' AS proof FROM t0)")
    out += [folded("t", f"f{k + 1}", k, f"f{k}") for k in range(levels)]
    out.append(
        f"g0 AS (SELECT 0 AS tree, s0.pos, doc_id, leaf, f, proof, s0.d AS subroot FROM f{levels} f JOIN s0 ON f.tree IS NOT DISTINCT FROM s0.lang)"
    )
    out += [folded("s", f"g{k + 1}", k, f"g{k}") for k in range(levels)]
    return (
        "WITH RECURSIVE " + ",\n".join(out) + f"""
SELECT doc_id, leaf, subroot, s.d AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = s.d AS verified
FROM g{levels} g, s{levels} s"""
    )


ORACLES: dict[str, str] = {
    "op1_bagminhash": NEAR_DUPLICATES,
    "op8_licence_bands": licence_sql(),
    "op11_letter_counts": spelling_sql(),
    "op13_merkle_manifest": merkle_sql(),
}
