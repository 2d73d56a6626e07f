"""SQL twins of the queries of this folder that SQL can express."""

from __future__ import annotations

from tocsin.llm import mixing, sharding

ORACLE: dict[str, str] = {}

ORACLE["op1_topk"] = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored
)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 10
"""

ORACLE["op2_mixing"] = f"""
WITH RECURSIVE sized AS (
  SELECT coalesce(source, '') AS source, doc_id,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) + 1 AS size
  FROM documents
), classes AS (
  SELECT source, doc_id, size, count(*) AS n FROM sized GROUP BY ALL
), totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS tokens FROM sized GROUP BY source
), total AS (SELECT CAST(sum(tokens) AS BIGINT) AS t FROM totals
), shares AS (SELECT list(tokens / t::DOUBLE) AS p FROM totals, total
), halvings AS (
  SELECT 0 AS step, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high
  UNION ALL
  SELECT step + 1, if(fits, low, (low + high) / 2), if(fits, (low + high) / 2, high)
  FROM (SELECT halvings.*, list_max(list_transform(p, lambda x: pow(x, (low + high) / 2) / x))
          / list_sum(list_transform(p, lambda x: pow(x, (low + high) / 2))) <= {mixing.MAX_REPEATS} AS fits
        FROM halvings, shares)
  WHERE step < {mixing.DEPTH}
), power AS (
  SELECT if(list_max(list_transform(p, lambda x: 1 / x)) / len(p) <= {mixing.MAX_REPEATS}, 0.0, high) AS a
  FROM halvings, shares WHERE step = {mixing.DEPTH}
), raised AS (
  SELECT source, tokens, pow(tokens / t::DOUBLE, a) AS r FROM totals, total, power
), planned AS (
  SELECT source, tokens,
         CAST(floor(r / (SELECT sum(r) FROM raised) * t::DOUBLE) AS BIGINT) AS quota
  FROM raised, total
), turns AS (
  SELECT c.*, tokens, quota, unnest(range(0, quota // tokens + 1)) AS turn
  FROM classes c JOIN planned USING (source)
), ordered AS (
  SELECT *, md5(concat_ws('|', '0', turn, source, coalesce('k' || doc_id, 'null'), size)) AS digest
  FROM turns
), laid AS (
  SELECT *, coalesce(sum(size * n) OVER (PARTITION BY source, turn ORDER BY digest, doc_id, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM ordered
), kept AS (
  -- The last pass is cut inside a class of equal rows.
  SELECT *, unnest(range(0, CASE WHEN turn < quota // tokens THEN n
    ELSE greatest(0, least(n, (quota % tokens - start) // size)) END::BIGINT)) AS copy
  FROM laid
), blocked AS (
  SELECT *, CAST(floor((turn * tokens + start + copy * size)::DOUBLE / quota::DOUBLE
    * greatest(1, (SELECT sum(quota) FROM planned) // {mixing.BLOCK_TOKENS})::DOUBLE) AS BIGINT) AS block
  FROM kept
)
SELECT doc_id, source, CAST(size AS BIGINT) AS size, CAST(turn AS INTEGER) AS pass,
       CAST(copy AS BIGINT) AS copy, block,
       CAST(row_number() OVER (PARTITION BY block ORDER BY digest, doc_id, copy) - 1 AS INTEGER) AS slot
FROM blocked
"""

ORACLE["op8_chat"] = """
WITH told AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS text
  FROM conversations
), views AS (SELECT DISTINCT conv_id, speaker AS view FROM told WHERE speaker <> 'system'
), rendered AS (
  SELECT t.*, view,
    CASE WHEN speaker = view THEN '<|assistant|>' || chr(10)
         WHEN speaker = 'system' THEN '<|system|>' || chr(10)
         ELSE '<|user ' || regexp_replace(speaker, '[|<>\\r\\n]', '_', 'g') || '|>' || chr(10)
    END AS head
  FROM told t JOIN views v ON t.conv_id IS NOT DISTINCT FROM v.conv_id
), whole AS (
  SELECT *, head || replace(text, '<|', '< |') || '<|end|>' || chr(10) AS segment FROM rendered
), placed AS (
  SELECT *, coalesce(sum(length(segment)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
      AS start, row_number() OVER w - 1 AS position
  FROM whole WINDOW w AS (PARTITION BY conv_id, view ORDER BY turn NULLS FIRST, speaker, text)
)
SELECT conv_id, view, CAST(position AS BIGINT) AS position, turn, speaker, segment,
       CAST(start AS BIGINT) AS start,
       CAST(start + CASE WHEN speaker = view THEN length(head) ELSE length(segment) END AS BIGINT)
         AS learn_from,
       CAST(start + length(segment) AS BIGINT) AS stop
FROM placed
"""


def _draw(path: str, weights: dict[int, float]) -> str:
    """The child with the least draw, as SQL."""
    draws = ", ".join(
        f"{{'d': -ln((CAST('0x' || substr(md5(concat_ws('|', k, '{path}/{child}')), 1, 13) AS BIGINT)"
        f" + 0.5) / 4503599627370496) / {weight}::DOUBLE, 'c': {child}}}"
        for child, weight in weights.items()
    )
    return f"list_sort([{draws}])[1].c"


def _descent(added: int) -> str:
    """Regions of three racks of four shards each, and then regions of a single shard."""
    racks = {0: 4.0, 1: 4.0, 2: 4.0}
    full = sharding.SHARDS // 12
    regions = {r: 12.0 for r in range(full)} | {full + i: 1.0 for i in range(added)}
    arms = []
    for region in range(full):
        inner = " ".join(
            f"WHEN {rack} THEN "
            + _draw(f"shard/{region}/{rack}", {12 * region + 4 * rack + i: 1.0 for i in range(4)})
            for rack in racks
        )
        arms.append(f"WHEN {region} THEN CASE {_draw(f'rack/{region}', racks)} {inner} END")
    arms += [f"WHEN {full + i} THEN {sharding.SHARDS + i}" for i in range(added)]
    return f"CASE {_draw('region', regions)} {' '.join(arms)} END"


_NIBBLES = """list_transform(range(16), lambda i: list_reduce(list_concat([i], range(4)),
  lambda c, step: if(c % 2 = 1, xor(c >> 1, 3988292384), c >> 1)))"""

ORACLE["op10_sharding"] = f"""
WITH bytes AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), nibbles AS (SELECT {_NIBBLES} AS t
), sized AS (
  SELECT doc_id, CAST(length(h) // 2 + 8 AS BIGINT) AS size,
    CAST(xor(4294967295, list_reduce(
      list_concat([4294967295::BIGINT], list_transform(range(length(h)),
        lambda i: CAST('0x' || h[if(i % 2 = 0, i + 2, i)] AS BIGINT))),
      lambda c, b: xor(c >> 4, t[xor(c, b) % 16 + 1]))) AS BIGINT) AS text_crc32
  FROM bytes, nibbles
), keyed AS (SELECT *, coalesce('k' || doc_id, 'null') AS k FROM sized
), placed AS (
  SELECT *, {_descent(0)} AS shard, {_descent(1)} AS grown_shard,
    md5(concat_ws('|', k, size, text_crc32)) AS digest
  FROM keyed
)
SELECT doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
  CAST(row_number() OVER (PARTITION BY shard ORDER BY digest, doc_id, size, text_crc32) - 1 AS BIGINT)
    AS slot,
  CAST(grown_shard AS INTEGER) AS grown_shard
FROM placed
"""
