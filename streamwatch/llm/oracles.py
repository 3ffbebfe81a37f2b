"""SQL that gives the same rows as a query, where SQL can express it.

The other operators use tokenizers, trained models, hashes that SQL lacks or edit distances; ``tests/llm`` compares
them with plain Python.
"""

from __future__ import annotations

_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def _base32(hexadecimal: str) -> str:
    """Base 32 of a SHA-1 digest in hexadecimal: five of its digits are four characters."""
    found = []
    for k in range(8):
        number = f"CAST('0x' || substr({hexadecimal}, {5 * k + 1}, 5) AS BIGINT)"
        found += [f"substr('{_ALPHABET}', 1 + CAST(({number} >> {shift}) & 31 AS BIGINT), 1)" for shift in (15, 10, 5, 0)]
    return " || ".join(found)


_ARCHIVES = f"""
  WITH digests AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS digest,
           max(page_id) OVER (PARTITION BY coalesce(html, '')) AS newest
    FROM pages
  )
  SELECT page_id, payload_bytes, {_base32('digest')} AS payload_digest,
         CASE WHEN page_id = newest THEN 'response' ELSE 'revisit' END AS record_type,
         CASE WHEN page_id <> newest THEN newest END AS refers_to
  FROM digests"""

_CHATS = r"""
  WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT * FROM (VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok'))
  )
  SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
         sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
         CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
         sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
         CAST(sum(14 + length(role || text) + length(regexp_replace(role || text, '[^\\<#]', '', 'g'))) AS BIGINT) AS formatted_chars
  FROM rows GROUP BY conv_id"""

#: Levels of a tree that the SQL states: sixteen to the sixth leaves.
_LEVELS = 6


def _tree_levels(name: str) -> str:
    """From ``{name}0`` (tree, place, n, digest) the nodes of all levels, and what stands before and after each in its run."""
    parts = []
    for k in range(_LEVELS):
        around = "string_agg(digest, '') OVER (PARTITION BY tree, place // 16 ORDER BY place ROWS BETWEEN"
        parts.append(f"""
      {name}{k}_runs AS MATERIALIZED (
        SELECT tree, place, n, coalesce({around} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS head,
               coalesce({around} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS tail
        FROM {name}{k}
      ),
      {name}{k + 1} AS MATERIALIZED (
        SELECT tree, place // 16 AS place, (any_value(n) + 15) // 16 AS n,
               CASE WHEN any_value(n) = 1 THEN any_value(digest) ELSE sha256(string_agg(digest, '' ORDER BY place)) END AS digest
        FROM {name}{k} GROUP BY tree, place // 16
      )""")
    return ",".join(parts)


def _folds(name: str, nodes: str) -> str:
    """Rows of ``{name}0`` (tree, place, digest, siblings and more) followed up the levels of ``nodes``."""
    return ",".join(
        f"""
      {name}{k + 1} AS (
        SELECT f.* REPLACE (f.place // 16 AS place, siblings || r.head || r.tail AS siblings,
               CASE WHEN r.n = 1 THEN f.digest ELSE sha256(r.head || f.digest || r.tail) END AS digest)
        FROM {name}{k} f JOIN {nodes}{k}_runs r USING (tree, place)
      )"""
        for k in range(_LEVELS)
    )


def _values(*columns: str) -> str:
    return "sha256(" + " || ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in columns) + ")"


def _crc32(text: str) -> str:
    """CRC-32 bit by bit: a byte goes in, then eight shifts."""
    steps = f"flatten(list_transform(range(1, length({text}) + 1), lambda i: [CAST(ascii(substr({text}, i, 1)) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))"
    shifted = "lambda c, x: xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1))"
    return f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {steps}), {shifted}), 4294967295)"


_LOWER_TEXT = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_MANIFEST = f"""
  WITH leaves AS MATERIALIZED (
    SELECT doc_id, coalesce('=' || source, '') AS tree, {_values('doc_id', 'source', 'lang', 'n_chars', 'text')} AS leaf,
           CASE WHEN {_crc32('CAST(doc_id AS VARCHAR)')} % 5 = 0 THEN {_values('doc_id', 'source', 'lang', 'n_chars', _LOWER_TEXT)} END AS altered
    FROM documents
  ),
  numbered AS MATERIALIZED (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY tree) AS n FROM leaves
  ),
  a0 AS MATERIALIZED (SELECT tree, place, n, leaf AS digest FROM numbered),
  {_tree_levels('a')},
  subroots AS MATERIALIZED (SELECT tree AS name, digest AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS n FROM a{_LEVELS}),
  b0 AS MATERIALIZED (SELECT '' AS tree, place, n, subroot AS digest FROM subroots),
  {_tree_levels('b')},
  f0 AS (SELECT doc_id, leaf, tree, place, coalesce(altered, leaf) AS digest, '' AS siblings FROM numbered),
  {_folds('f', 'a')},
  g0 AS (SELECT doc_id, leaf, subroot, '' AS tree, s.place, digest, siblings FROM f{_LEVELS} f JOIN subroots s ON s.name = f.tree),
  {_folds('g', 'b')}
  SELECT doc_id, leaf, subroot, root, sha256(siblings) AS proof_sha256, digest AS folded_root, digest = root AS verified
  FROM g{_LEVELS}, (SELECT digest AS root FROM b{_LEVELS})"""

_PHRASES = r"""
  WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
  ),
  lists AS MATERIALIZED (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS words FROM pieces),
  sizes AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM lists GROUP BY lang),
  grams AS (
    SELECT lang, m AS size, unnest(list_transform(range(1, len(words) - m + 2), lambda k: array_to_string(words[k : k + m - 1], ' '))) AS phrase
    FROM lists, (VALUES (1), (2), (3)) AS sizes(m) WHERE len(words) >= m
  ),
  counts AS MATERIALIZED (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL),
  candidates AS MATERIALIZED (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS words FROM counts WHERE size > 1 AND f >= 10),
  covered AS (
    SELECT lang, phrase, max(f) AS most
    FROM (SELECT lang, unnest([words[1] || ' ' || words[2], words[2] || ' ' || words[3]]) AS phrase, a AS f FROM candidates WHERE size = 3)
    GROUP BY ALL
  ),
  cuts AS (
    SELECT lang, phrase, a, k, array_to_string(words[1 : k], ' ') AS head, array_to_string(words[k + 1 : size], ' ') AS rest
    FROM candidates LEFT JOIN covered USING (lang, phrase), (VALUES (1), (2)) AS places(k)
    WHERE k < size AND (most IS NULL OR 100 * most < 50 * a)
  ),
  scores AS (
    SELECT c.lang, c.phrase, a, k, h.f AS l, t.f AS r, 1000000 * a::HUGEINT * a // (h.f::HUGEINT * t.f) AS score
    FROM cuts c JOIN counts h ON h.lang = c.lang AND h.phrase = head JOIN counts t ON t.lang = c.lang AND t.phrase = rest
  ),
  weakest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
  SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
  FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM weakest) JOIN sizes USING (lang)
  WHERE rank <= 2000"""

ORACLES: dict[str, str] = {"op7_arc_to_warc": _ARCHIVES, "op9_chat_format": _CHATS, "op11_phrase_mining": _PHRASES, "op12_merkle_manifest": _MANIFEST}
