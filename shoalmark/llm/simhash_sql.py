"""The SimHash query in DuckDB SQL: XXH64 in unsigned arithmetic modulo 2^64, fingerprints, links and components."""

from __future__ import annotations

# The five primes of XXH64.
P1, P2, P3, P4, P5 = 11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261
_ALL = 1 << 64


def _wide(a: str) -> str:
    return f"({a})::UHUGEINT"


def _mod(a: str) -> str:
    return f"(({a}) & {_ALL - 1}::UHUGEINT)::UBIGINT"


def _mul(a: str, b: int) -> str:
    return _mod(f"{_wide(a)} * {b}::UHUGEINT")


def _add(a: str, b: str) -> str:
    return _mod(f"{_wide(a)} + {_wide(b)}")


def _turn(x: str, r: int) -> str:
    return f"((({_wide(x)} * {1 << r}::UHUGEINT) & {_ALL - 1}::UHUGEINT) | (({x})::UBIGINT >> {64 - r}::UBIGINT)::UHUGEINT)::UBIGINT"


def _xor(a: str, b: str) -> str:
    return f"xor(({a})::UBIGINT, ({b})::UBIGINT)"


def _shift(x: str, r: int) -> str:
    return f"(({x}) >> {r}::UBIGINT)"


def _round(total: str, lane: str) -> str:
    return _mul(_turn(_add(total, _mul(lane, P2)), 31), P1)


def _merge(h: str, v: str) -> str:
    return _add(_mul(_xor(h, _round("0", v)), P1), str(P4))


def _little(at: str, size: int) -> str:
    """The number of so many bytes of the hex text x from a byte on, the first byte the least."""
    octets = " || ".join(f"substr(x, CAST(2 * ({at}) + {2 * k + 1} AS INTEGER), 2)" for k in range(size - 1, -1, -1))
    return f"CAST('0x' || {octets} AS UBIGINT)"


def xxh64(source: str, seed: int = 42) -> str:
    """Common table expressions that end in hashed: the rows of source (with the text s) and their hash h."""
    start = [(seed + P1 + P2) % _ALL, (seed + P2) % _ALL, seed, (seed - P1) % _ALL]
    lanes = ", ".join(f"list_reduce(q[{i + 1}:4 * ns:4], lambda a, l: {_round('a', 'l')}, {v}::UBIGINT) AS v{i + 1}" for i, v in enumerate(start))
    mixed = _add(_add(_turn("v1", 1), _turn("v2", 7)), _add(_turn("v3", 12), _turn("v4", 18)))
    rest = "n // 8 * 8 + CASE WHEN n % 8 >= 4 THEN 4 ELSE 0 END"
    return f"""x0 AS (SELECT *, hex(encode(s)) AS x, strlen(s) AS n FROM {source}),
x1 AS (SELECT *, list_transform(range(0, n // 8), lambda k: {_little("8 * k", 8)}) AS q, n // 32 AS ns FROM x0),
x2 AS (SELECT *, {lanes} FROM x1),
x3 AS (SELECT *, {mixed} AS h0 FROM x2),
x4 AS (SELECT *, {_merge("h0", "v1")} AS h1 FROM x3),
x5 AS (SELECT *, {_merge("h1", "v2")} AS h2 FROM x4),
x6 AS (SELECT *, {_merge("h2", "v3")} AS h3 FROM x5),
x7 AS (SELECT *, {_merge("h3", "v4")} AS h4 FROM x6),
x8 AS (SELECT *, {_add(f"CASE WHEN ns > 0 THEN h4 ELSE {(seed + P5) % _ALL}::UBIGINT END", "n")} AS g0 FROM x7),
x9 AS (SELECT *, list_reduce(q[4 * ns + 1:], lambda h, l: {_add(_mul(_turn(_xor("h", _round("0", "l")), 27), P1), str(P4))}, g0) AS g1 FROM x8),
y1 AS (SELECT *, CASE WHEN n % 8 >= 4 THEN {_xor("g1", _mul(_little("n // 8 * 8", 4), P1))} END AS y FROM x9),
y2 AS (SELECT *, CASE WHEN n % 8 >= 4 THEN {_add(_mul(_turn("y", 23), P2), str(P3))} ELSE g1 END AS g2, {rest} AS done FROM y1),
y3 AS (SELECT *, list_reduce(list_transform(range(done, n), lambda k: {_little("k", 1)}), lambda h, l: {_mul(_turn(_xor("h", _mul("l", P5)), 11), P1)}, g2) AS g3 FROM y2),
y4 AS (SELECT *, {_mul(_xor("g3", _shift("g3", 33)), P2)} AS z1 FROM y3),
y5 AS (SELECT *, {_mul(_xor("z1", _shift("z1", 29)), P3)} AS z2 FROM y4),
hashed AS (SELECT *, {_xor("z2", _shift("z2", 32))} AS h FROM y5)"""


_BITS = " + ".join(f"CASE WHEN 2 * sum(CAST((h >> {b}::UBIGINT) & 1::UBIGINT AS INTEGER)) > count(*) THEN {1 << b}::UHUGEINT ELSE 0::UHUGEINT END" for b in range(64))
_DIFFER = " + ".join(f"bit_count(CAST({_shift(_xor('a.fp', 'b.fp'), 32 * k)} % {1 << 32} AS BIGINT))" for k in range(2))

SQL = f"""WITH RECURSIVE d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT doc_id, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws FROM d),
p AS (SELECT doc_id, ws, unnest(generate_series(1, greatest(1, len(ws) - 3))) AS i FROM w WHERE len(ws) > 0),
sh AS (SELECT doc_id, array_to_string(ws[i:i + 3], ' ') AS s FROM p),
{xxh64("sh")},
prints AS (SELECT doc_id, ({_BITS})::UBIGINT AS fp FROM hashed GROUP BY doc_id),
f AS (SELECT doc_id, coalesce(fp, 0::UBIGINT) AS fp FROM d LEFT JOIN prints USING (doc_id)),
nodes AS (SELECT fp, min(doc_id) AS least FROM f GROUP BY fp),
links AS (SELECT a.fp AS x, b.fp AS y FROM nodes a JOIN nodes b ON {_DIFFER} <= 4),
reach(x, y) AS (SELECT fp, fp FROM nodes UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
named AS (SELECT x, min(least) AS component_id FROM reach JOIN nodes ON y = fp GROUP BY x)
SELECT doc_id, format('{{:016x}}', fp) AS fingerprint, component_id FROM f JOIN named ON fp = x"""
