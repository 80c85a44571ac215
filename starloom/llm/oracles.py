"""The operators in DuckDB's SQL, where SQL can say them."""

from __future__ import annotations

from starloom.llm import fm_index, line_dedup, repair, sharding, variants

_LINE_DEDUP = f"""
WITH lines AS (
  SELECT doc_id, md5(text) AS version, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i
  FROM documents WHERE text IS NOT NULL
), hashed AS (
  SELECT *, ('0x' || substr(md5(line), 1, 7))::BIGINT AS h FROM lines
), rolled AS (
  SELECT *, (coalesce(lag(h) OVER d, 0) * {line_dedup.BASE} + h) % {line_dedup.PRIME} AS r
  FROM hashed WINDOW d AS (PARTITION BY doc_id, version ORDER BY i)
), edges AS (
  SELECT *, lag(r) OVER d AS ahead, coalesce(lead(r) OVER d, {line_dedup.PRIME}) AS behind
  FROM rolled WINDOW d AS (PARTITION BY doc_id, version ORDER BY i)
), placed AS (
  SELECT *, sum(CASE WHEN i = 0 OR (i > 1 AND r < ahead AND r <= behind) THEN 1 ELSE 0 END)
            OVER (PARTITION BY doc_id, version ORDER BY i) - 1 AS place
  FROM edges
), chunks AS (
  SELECT doc_id, version, place, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS chunk
  FROM placed GROUP BY doc_id, version, place
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY chunk, n >= {line_dedup.MIN_LINES}
                               ORDER BY doc_id, version, place) AS occurrence
  FROM chunks
), judged AS (
  SELECT *, occurrence > 1 AND n >= {line_dedup.MIN_LINES} AND regexp_matches(chunk, '\\S') AS removed
  FROM ranked
), cleaned AS (
  SELECT doc_id, version, count(*) AS n_chunks, sum(removed::INT)::BIGINT AS n_removed,
         coalesce(string_agg(chunk, chr(10) ORDER BY place) FILTER (WHERE NOT removed), '') AS text
  FROM judged GROUP BY doc_id, version
)
SELECT d.doc_id, coalesce(n_chunks, 0) AS n_chunks, coalesce(n_removed, 0) AS n_removed,
       CASE WHEN d.text IS NOT NULL THEN c.text END AS text
FROM documents d LEFT JOIN cleaned c ON c.doc_id = d.doc_id AND c.version = md5(d.text)
"""

_WORDS = r"regexp_extract_all({}, '[0-9A-Za-z\x{{80}}-\x{{10FFFF}}]+')"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_DECONTAMINATION = f"""
WITH d AS (
  SELECT doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS w FROM documents
), b AS (
  SELECT item_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least({fm_index.WINDOW}, len(w)) AS k,
         array_to_string(w[i : i + least({fm_index.WINDOW}, len(w)) - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, greatest(len(w) - {fm_index.WINDOW} + 1, 1) + 1)) AS i
        FROM b WHERE len(w) > 0)
), sizes AS (
  SELECT DISTINCT k FROM windows
), places AS (
  SELECT doc_id, k, i, array_to_string(w[i : i + k - 1], ' ') AS phrase
  FROM (SELECT d.doc_id, d.w, s.k, unnest(range(1, len(d.w) - s.k + 2)) AS i
        FROM d JOIN sizes s ON len(d.w) >= s.k)
), found AS (
  SELECT DISTINCT a.doc_id, a.i, a.k, x.item_id FROM places a JOIN windows x USING (k, phrase)
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM found) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
         string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
  FROM found GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""


# Fixed value: the reversed polynomial of the CRC-32 that zlib and Spark compute.
_CRC_TABLE = """
  steps(i, k, c) AS (
    SELECT i, 0, i FROM range(256) r(i) UNION ALL
    SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END
    FROM steps WHERE k < 8
  ), entries AS (SELECT list(c ORDER BY i) AS t FROM steps WHERE k = 8)
"""


def _crc32(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes; ``entries`` must be joined."""
    return f"""xor(4294967295, list_reduce(
        list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda b: ('0x' || b)::BIGINT),
        lambda c, b: xor(t[1 + (xor(c, b) & 255)], c >> 8), 4294967295::BIGINT))"""


def _shard(n: int) -> str:
    scores = ", ".join(
        f"{{'s': -1 / ln((('0x' || substr(md5(key || '#{i}'), 1, {sharding.HEX_DIGITS}))::BIGINT + 0.5)"
        f" / 16.0::DOUBLE ** {sharding.HEX_DIGITS}), 'i': -{i}}}"
        for i in range(n)
    )
    return f"(-list_max([{scores}]).i)::INTEGER"


_SHARDING = f"""
WITH RECURSIVE {_CRC_TABLE}, sized AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size,
         {_crc32("coalesce(text, '')")} AS text_crc32,
         coalesce(doc_id::VARCHAR, 'null') AS key
  FROM documents, entries
), dealt AS (
  SELECT doc_id, size, text_crc32, {_shard(8)} AS shard, {_shard(9)} AS grown_shard FROM sized
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, size, text_crc32, grown_shard) - 1 AS slot,
       grown_shard
FROM dealt
"""

_VARIANTS = rf"""
WITH RECURSIVE {_CRC_TABLE}, runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS key, run, length(run) AS size, count(*) AS c
  FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER.format("coalesce(text, '')")},
               '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents)
  GROUP BY ALL HAVING length(run) >= {variants.MIN_LENGTH}
), hashed AS (
  SELECT *, {_crc32("key")} AS h FROM runs, entries
), words AS (
  SELECT word, sum(c)::BIGINT AS n
  FROM (SELECT c, CASE WHEN h % {variants.DAMAGE} = 0
                  THEN substr(run, 1, h % size) || substr(run, h % size + 2, size) ELSE run END AS word
        FROM hashed)
  WHERE length(word) >= {variants.MIN_LENGTH} GROUP BY word HAVING sum(c) >= {variants.MIN_COUNT}
), less AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1, length(word)) AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT a.word, b.word AS other FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT w.word, l.word FROM words w JOIN less l ON l.rest = w.word
  UNION SELECT l.word, w.word FROM words w JOIN less l ON l.rest = w.word
), best AS (
  SELECT r.word, count(*) AS n_near, min({{'less': -w.n, 'other': r.other}}) AS b
  FROM near r JOIN words w ON w.word = r.other GROUP BY r.word
), forms AS (
  SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near,
         CASE WHEN -b.less >= {variants.FORM_FACTOR} * n THEN b.other END AS form,
         CASE WHEN -b.less >= {variants.FORM_FACTOR} * n THEN (-b.less)::BIGINT END AS form_n
  FROM words LEFT JOIN best USING (word)
), chain(word, root) AS (
  SELECT word, word FROM forms UNION ALL
  SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n
FROM forms f JOIN chain c USING (word) JOIN forms e ON e.word = c.root AND e.form IS NULL
"""

_SPACE = f"chr({'), chr('.join(str(ord(c)) for c in repair.WHITE)})"
# States as in the operator: nothing read, system, user, assistant. An offer to reach one
# is a cost, the edits' initials and the lines, and the least one stays.
_NONE = "{'c': 1000000000, 'a': '', 't': []::VARCHAR[]}"


def _offers(to: int) -> str:
    """Ways to state ``to`` past row ``r.x`` from the states ``q.s``, as a list."""
    extra = f"(CASE r.x.fault WHEN 'truncated' THEN {repair.TRUNCATED} ELSE 0 END)"
    out = [f"{{'c': q.s[{to + 1}].c + {repair.DELETE}, 'a': q.s[{to + 1}].a || 'D', 't': q.s[{to + 1}].t}}"]

    def offer(state: int, cost: int, letters: str, inserted: list[str], role: str, when: str) -> None:
        lines = ", ".join([*(f"'{i}:'" for i in inserted), f"{role} || ':' || r.x.text"])
        out.append(
            f"CASE WHEN r.x.fault NOT IN ('blank', 'duplicate') AND {when} THEN "
            f"{{'c': q.s[{state + 1}].c + {cost} + {extra}, 'a': q.s[{state + 1}].a || '{letters}', "
            f"'t': list_concat(q.s[{state + 1}].t, [{lines}])}} ELSE {_NONE} END"
        )

    initial = {1: "s", 2: "u", 3: "a"}
    for state in range(4):
        if to == 1:
            if state == 0:
                offer(state, 0, "K", [], "r.x.role", "r.x.role[1] = 's'")
            continue
        if to == 0:
            continue
        between = repair.NEXT[state]
        if between == to:
            offer(state, 0, "K", [], "r.x.role", f"r.x.role[1] = '{initial[to]}'")
            offer(state, repair.REROLE, "R", [], f"'{repair.ROLES[to]}'", "true")
        elif repair.NEXT[between] == to:
            first = [repair.ROLES[between]]
            offer(state, repair.INSERT, "IK", first, "r.x.role", f"r.x.role[1] = '{initial[to]}'")
            offer(state, repair.INSERT + repair.REROLE, "IR", first, f"'{repair.ROLES[to]}'", "true")
    return f"list_min([{', '.join(out)}])"


_REPAIR = f"""
WITH RECURSIVE {_CRC_TABLE}, given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
  FROM conversations
), hashed AS (
  SELECT *, {_crc32("key")} % 20 AS h FROM given, entries
), damaged AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
         CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM hashed, range(CASE WHEN h = 3 THEN 2 ELSE 1 END) WHERE h <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
         rtrim(text, concat({_SPACE})) AS body
  FROM damaged
), judged AS (
  SELECT *, CASE WHEN body = '' THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                 WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault,
         lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] AS pair
  FROM placed
), gathered AS (
  SELECT conv_id,
         coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal,
         list({{'role': role, 'text': text, 'fault': fault}} ORDER BY i) AS turns
  FROM judged GROUP BY conv_id
), way(conv_id, i, s) AS (
  SELECT conv_id, 0, [{{'c': 0, 'a': '', 't': []::VARCHAR[]}}, {_NONE}, {_NONE}, {_NONE}] FROM gathered UNION ALL
  SELECT q.conv_id, q.i + 1, [{', '.join(_offers(to) for to in range(4))}]
  FROM way q JOIN (SELECT conv_id, unnest(turns) AS x, generate_subscripts(turns, 1) AS i FROM gathered) r
    ON r.conv_id IS NOT DISTINCT FROM q.conv_id AND r.i = q.i + 1
), ended AS (
  SELECT w.conv_id, list_min([
    w.s[1], w.s[4],
    {{'c': w.s[2].c + {2 * repair.INSERT}, 'a': w.s[2].a || 'II', 't': list_concat(w.s[2].t, ['user:', 'assistant:'])}},
    {{'c': w.s[3].c + {repair.INSERT}, 'a': w.s[3].a || 'I', 't': list_concat(w.s[3].t, ['assistant:'])}}]) AS e
  FROM way w JOIN gathered g ON g.conv_id IS NOT DISTINCT FROM w.conv_id AND w.i = len(g.turns)
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(e.c, 0)::BIGINT AS cost,
       coalesce(e.a, '') AS audit, sha256(coalesce(array_to_string(e.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN gathered g ON g.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op6_sharding": _SHARDING,
        "op7_line_dedup": _LINE_DEDUP,
        "op10_decontamination": _DECONTAMINATION,
        "op11_conversation_repair": _REPAIR,
        "op12_spelling_variants": _VARIANTS,
    }
