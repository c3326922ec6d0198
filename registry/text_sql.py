"""SQL for hashed tf-idf vectors of texts.

Words are hashed to buckets as Spark's HashingTF does it: 32-bit MurmurHash3 of the
UTF-8 bytes with seed 42, taken modulo the number of buckets. DuckDB has no such
function, so the published algorithm is written out on lists of numbers.
"""

from __future__ import annotations

DIMENSIONS = 256

# Fixed values of MurmurHash3 (x86, 32 bits), and 2 to the 32nd.
_M = "4294967296"
_C1, _C2, _ADD = "3432918353", "461845907", "3864292196"
_MIX1, _MIX2 = "2246822507", "3266489909"
_SEED = "42"


def _times(x: str, factor: str) -> str:
    return f"(({x}) * CAST({factor} AS HUGEINT) % {_M})"


def _rotate(x: str, bits: int) -> str:
    return f"(({x}) * {2 ** bits} % {_M} + ({x}) // {2 ** (32 - bits)})"


def _number(*hex_bytes: str) -> str:
    return f"CAST('0x' || {' || '.join(hex_bytes)} AS HUGEINT)"


def _byte(offset: str) -> str:
    return f"substr(h, CAST({offset} AS BIGINT), 2)"


def _each(values: str, step: str) -> str:
    return f"list_transform({values}, lambda x: {step})"


def _scrambled(values: str) -> str:
    for step in (_times("x", _C1), _rotate("x", 15), _times("x", _C2)):
        values = _each(values, step)
    return values


def bucketed(words: str, p: str = "") -> str:
    """CTEs, prefixed with ``p``, ending in ``buckets(word, bucket)`` for ``words(word)``."""
    block = _number(*[_byte(f"8 * x + {i}") for i in (7, 5, 3, 1)])
    rest = "8 * (n // 4)"
    tail = (f"CASE n % 4 WHEN 0 THEN CAST(0 AS HUGEINT) "
            f"WHEN 1 THEN {_number(_byte(rest + ' + 1'))} "
            f"WHEN 2 THEN {_number(_byte(rest + ' + 3'), _byte(rest + ' + 1'))} "
            f"ELSE {_number(*[_byte(f'{rest} + {i}') for i in (5, 3, 1)])} END")
    mixed = "xor(acc, x)"
    return f"""
{p}hexed AS (SELECT DISTINCT word, hex(encode(word)) AS h, strlen(word) AS n FROM {words}),
{p}scrambled AS (
  SELECT word, n, {_scrambled(_each("range(0, n // 4)", block))} AS blocks,
         {_scrambled(f"[{tail}]")}[1] AS tail
  FROM {p}hexed),
{p}body AS (
  SELECT word, xor(xor(list_reduce(list_prepend(CAST({_SEED} AS HUGEINT), blocks),
    lambda acc, x: ({_rotate(mixed, 13)} * 5 + {_ADD}) % {_M}), tail), CAST(n AS HUGEINT)) AS a
  FROM {p}scrambled),
{p}mix1 AS (SELECT word, {_times("xor(a, a // 65536)", _MIX1)} AS b FROM {p}body),
{p}mix2 AS (SELECT word, {_times("xor(b, b // 8192)", _MIX2)} AS c FROM {p}mix1),
{p}buckets AS (
  SELECT word, CAST(xor(c, c // 65536) % {DIMENSIONS} AS INTEGER) AS bucket FROM {p}mix2)"""


def split_words(rows: str, identity: str, text: str) -> str:
    """``{identity}, word``: the lower-case words between white space."""
    return f"""SELECT {identity}, word FROM (
  SELECT {identity}, unnest(string_split_regex(lower({text}), '[\\t\\n\\v\\f\\r ]+')) AS word
  FROM {rows}) WHERE word <> ''"""


def weighted(counts: str, weights: str, identity: str) -> str:
    """``{identity}, bucket, weight``: idf-weighted, of unit length, as single floats.

    ``counts`` has ``{identity}, bucket, n``; ``weights`` has ``bucket, w``.
    """
    return f"""SELECT {identity}, bucket,
    CAST(CAST(n * w / sqrt(sum(n * w * n * w) OVER (PARTITION BY {identity})) AS FLOAT) AS DOUBLE)
      AS weight
  FROM {counts} JOIN {weights} USING (bucket)"""


def idf(documents: str, counts: str) -> str:
    """``bucket, w`` for every bucket; ``counts`` are those of the documents."""
    return f"""SELECT bucket, ln((m + 1.0) / (coalesce(df, 0) + 1.0)) AS w
  FROM (SELECT CAST(unnest(range({DIMENSIONS})) AS INTEGER) AS bucket)
  LEFT JOIN (SELECT bucket, count(*) AS df FROM {counts} GROUP BY bucket) USING (bucket)
  CROSS JOIN (SELECT count(*) AS m FROM {documents})"""
