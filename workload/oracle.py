"""The same results in SQL, by brute force, for DuckDB. Twin of ``sky.py``."""

from __future__ import annotations

from starweave.functions.sphere import chord

from .sky import DEC_JITTER, DEC_STEP, HUB_ORDER, RA_JITTER, RA_STEP, SPOKES

LIMIT = repr(chord(1.0) ** 2)
SIDE = 1 << 29


def frac(x: str) -> str:
    return f"({x} - floor({x}))"


def indexed(inner: str) -> str:
    """Add ``_healpix_29`` to a relation with ra and dec."""
    spread = "(({x} | ({x} << {s})) & {m})"
    steps = [(16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)]
    body = f"""SELECT *, (CASE WHEN abs(hz) <= 2.0/3.0 THEN bface ELSE cface END) AS hface,
 (CASE WHEN abs(hz) <= 2.0/3.0 THEN hdown & {SIDE - 1} ELSE cx END) AS hx0,
 (CASE WHEN abs(hz) <= 2.0/3.0 THEN {SIDE - 1} - (hup & {SIDE - 1}) ELSE cy END) AS hy0
 FROM (SELECT *,
  CASE WHEN (hup >> 29) = (hdown >> 29) THEN (hup >> 29) | 4 WHEN (hup >> 29) < (hdown >> 29) THEN hup >> 29 ELSE (hdown >> 29) + 8 END AS bface,
  CASE WHEN dec >= 0 THEN hq ELSE hq + 8 END AS cface,
  CASE WHEN dec >= 0 THEN {SIDE - 1} - cdown ELSE cup END AS cx,
  CASE WHEN dec >= 0 THEN {SIDE - 1} - cup ELSE cdown END AS cy
  FROM (SELECT *,
   CASE WHEN abs(hz) <= 2.0/3.0 THEN CAST(floor({SIDE} * (0.5 + ht - 0.75 * hz)) AS BIGINT) ELSE 0 END AS hup,
   CASE WHEN abs(hz) <= 2.0/3.0 THEN CAST(floor({SIDE} * (0.5 + ht + 0.75 * hz)) AS BIGINT) ELSE 0 END AS hdown,
   CAST(least(floor((ht - hq) * hs), {SIDE - 1}) AS BIGINT) AS cup,
   CAST(least(floor((1.0 - (ht - hq)) * hs), {SIDE - 1}) AS BIGINT) AS cdown
   FROM (SELECT *, CAST(least(3, floor(ht)) AS BIGINT) AS hq,
     CAST({SIDE} AS DOUBLE) * sqrt(6.0::DOUBLE) * abs(sin(radians(90.0 - abs(dec)) / 2.0)) AS hs
    FROM (SELECT *, sin(radians(dec)) AS hz,
      CASE WHEN (ra - floor(ra / 360.0) * 360.0) / 90.0 >= 4.0 THEN 0.0::DOUBLE ELSE (ra - floor(ra / 360.0) * 360.0) / 90.0 END AS ht
     FROM ({inner})))))"""
    for n, (shift, mask) in enumerate(steps):
        x = spread.format(x=f"hx{n}", s=shift, m=mask)
        y = spread.format(x=f"hy{n}", s=shift, m=mask)
        body = f"SELECT *, {x} AS hx{n + 1}, {y} AS hy{n + 1} FROM ({body})"
    return f"SELECT *, hface * {SIDE * SIDE} + hx5 + 2 * hy5 AS _healpix_29 FROM ({body})"


def placed(table: str, owner: str, key: str | None, size: float, order: int) -> str:
    ra = f"(360.0::DOUBLE * {frac(f'({owner} * {RA_STEP!r}::DOUBLE)')})"
    dec = f"(180.0::DOUBLE * {frac(f'({owner} * {DEC_STEP!r}::DOUBLE + 0.5)')} - 90.0::DOUBLE)"
    if key:
        ra = f"({ra} + ({frac(f'({key} * {RA_JITTER!r}::DOUBLE)')} - 0.5) * {size!r}::DOUBLE)"
        dec = f"greatest(-90.0::DOUBLE, least(90.0::DOUBLE, {dec} + ({frac(f'({key} * {DEC_JITTER!r}::DOUBLE)')} - 0.5) * {size!r}::DOUBLE))"
    inner = f"SELECT *, {ra} AS ra, {dec} AS dec FROM {table}"
    return f"""SELECT *, {order} AS norder, _healpix_29 >> {2 * (29 - order)} AS npix,
 cos(radians(dec)) * cos(radians(ra)) AS vx, cos(radians(dec)) * sin(radians(ra)) AS vy, sin(radians(dec)) AS vz
 FROM ({indexed(inner)})"""


HUB = f"hub AS MATERIALIZED (SELECT *, 'c' || c_custkey AS object_id, c_custkey AS row_index FROM ({placed('customer', 'c_custkey', None, 0, HUB_ORDER)}))"

_SPOKE_TABLES = {
    "desi": ("orders", "o_custkey", "o_orderkey", "'o' || o_orderkey"),
    "sdss": ("events", "user_id", "event_id", "'e' || event_id"),
    "provabgs": ("supplier", "s_suppkey", "s_suppkey", "'s' || s_suppkey"),
}


def spoke(source: str) -> str:
    table, owner, key, name = _SPOKE_TABLES[source]
    order, size = SPOKES[source]
    return f"{source} AS MATERIALIZED (SELECT *, {name} AS partner_id, {key} AS row_index FROM ({placed(table, owner, key, size, order)}))"


def nearest(name: str, hub: str, partner: str, label: str, limit: str = LIMIT, band: str = "0.0003") -> str:
    """Brute force: all pairs in a declination band, then the best per anchor."""
    d2 = "(h.vx - s.vx) * (h.vx - s.vx) + (h.vy - s.vy) * (h.vy - s.vy) + (h.vz - s.vz) * (h.vz - s.vz)"
    return f"""{name} AS MATERIALIZED (SELECT norder, npix, anchor_id, '{label}' AS source, partner_norder, partner_npix, partner_id,
 2 * degrees(asin(sqrt(d2) / 2)) * 3600 AS separation
 FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY d2, partner_id) AS place
  FROM (SELECT h.norder, h.npix, h.object_id AS anchor_id, s.norder AS partner_norder, s.npix AS partner_npix, s.partner_id, {d2} AS d2
   FROM {hub} h JOIN {partner} s ON s.dec BETWEEN h.dec - {band} AND h.dec + {band})
  WHERE d2 <= {limit}) WHERE place = 1)"""


STAR = ",\n".join(
    [HUB, *[spoke(s) for s in SPOKES], *[nearest(f"e_{s}", "hub", s, s) for s in SPOKES]]
    + ["edges AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT * FROM e_{s}" for s in sorted(SPOKES)) + ")"]
)
PAIR = ",\n".join([HUB, spoke("desi"), nearest("e_desi", "hub", "desi", "desi")])


def query(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


def crc32(text: str) -> str:
    """CRC-32 of a string, byte by byte and bit by bit."""
    bits = (
        "list_reduce(list_prepend(xor(c, b), [0::BIGINT,1,2,3,4,5,6,7]), "
        "lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)"
    )
    codes = f"list_transform(string_split({text}, ''), lambda ch: ord(ch)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: {bits}), 4294967295)"


def split(order: str, pixel: str) -> str:
    """Spatial split of a cell."""
    return f"(CASE WHEN {crc32(f'CAST(({pixel} >> (2 * ({order} - 4))) AS VARCHAR)')} % 20 = 0 THEN 'val' ELSE 'train' END)"
