"""The derived tables stated in SQL, assembled as common table expressions."""

from __future__ import annotations

KR = "8494666.666666666"

# name -> (tables it needs, body)
TABLES: dict[str, tuple[tuple[str, ...], str]] = {}
HEADS: dict[str, str] = {}


def table(name: str, needs: tuple[str, ...], body: str, head: str | None = None) -> None:
    TABLES[name] = (needs, body)
    if head is not None:
        HEADS[name] = head


def query(needs: tuple[str, ...], body: str) -> str:
    """A query over derived tables: their CTEs in dependency order, then the body."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for inner in TABLES[name][0]:
            visit(inner)
        ordered.append(name)

    for name in needs:
        visit(name)
    recursive = " RECURSIVE" if any(n in HEADS for n in ordered) else ""
    ctes = ",\n".join(f"{HEADS.get(n, n + ' AS MATERIALIZED')} ({TABLES[n][1]})" for n in ordered)
    return f"WITH{recursive} {ctes}\n{body}" if ordered else body


table("gates", (), """
  SELECT volume_id, 'RAD' || CAST(volume_id % 4 + 1 AS VARCHAR) AS radar, volume_id % 4 AS geometry_id,
         sweep, ray, gate, CAST((sweep*36 + ray)*40 + gate AS BIGINT) AS gate_id,
         DBZH, DBZH - ZDR AS DBZV, ZDR, RHOHV, PHIDP, KDP, VRAD, WRAD, CM,
         sweep*1.5::DOUBLE + 0.5::DOUBLE AS elevation, ray*10.0::DOUBLE AS azimuth,
         gate*6000.0::DOUBLE + 3000 AS range_m
  FROM (SELECT l_suppkey // 25 AS volume_id, CAST(l_linenumber - 1 AS INT) AS sweep,
               CAST(l_orderkey % 36 AS INT) AS ray, CAST(l_partkey % 40 AS INT) AS gate,
               max(l_extendedprice/1500 - 10) AS DBZH, max(1 - 4*l_discount) AS RHOHV,
               min(l_quantity/5 - 1) AS ZDR, min(l_tax*100) AS WRAD, max(l_quantity - 25) AS VRAD,
               max(l_quantity*7) AS PHIDP, min(l_quantity/10 - 1) AS KDP,
               max(CASE WHEN l_discount > 0.085 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS CM
        FROM lineitem GROUP BY 1, 2, 3, 4) o""")

table("gxyz", ("gates",), f"""
  SELECT g.*, {KR}*asin(range_m*cos(radians(elevation))/({KR}+z))*sin(radians(azimuth)) AS x,
         {KR}*asin(range_m*cos(radians(elevation))/({KR}+z))*cos(radians(azimuth)) AS y
  FROM (SELECT *, sqrt(range_m*range_m + {KR}*{KR} + 2.0*range_m*{KR}*sin(radians(elevation))) - {KR} AS z
        FROM gates) g""")

table("sweeps", (), """
  SELECT DISTINCT l_suppkey // 25 AS volume_id, (l_suppkey // 25) % 4 AS geometry_id,
         CAST(l_linenumber - 1 AS INT) AS sweep, (l_linenumber - 1)*1.5::DOUBLE + 0.5::DOUBLE AS elevation,
         36 AS nrays, 40 AS ngates, 6000 AS gate_size, 3000 AS gate_offset
  FROM lineitem""")

# One scan serves every geometry of the derived data, so the map is searched once
# by brute force and then repeated per geometry.
table("scan_xyz", ("sweeps",), f"""
  SELECT gate_id, z, {KR}*asin(r*cos(radians(e))/({KR}+z))*sin(radians(a)) AS x,
         {KR}*asin(r*cos(radians(e))/({KR}+z))*cos(radians(a)) AS y
  FROM (SELECT CAST((sweep*36 + ray)*40 + gate AS BIGINT) AS gate_id, gate*6000.0::DOUBLE + 3000 AS r, ray*10.0::DOUBLE AS a,
               elevation AS e,
               sqrt(r*r + {KR}*{KR} + 2.0*r*{KR}*sin(radians(e))) - {KR} AS z
        FROM (SELECT DISTINCT sweep, elevation FROM sweeps) s,
             (SELECT unnest(range(36)) AS ray) a, (SELECT unnest(range(40)) AS gate) b) q""")

table("searched", (), f"""
  SELECT * FROM (
    SELECT CAST((iz*41 + iy)*41 + ix AS BIGINT) AS voxel_id, CAST(iz AS INT) AS iz, CAST(iy AS INT) AS iy,
           CAST(ix AS INT) AS ix, iz*3000.0::DOUBLE AS z, -240000.0::DOUBLE + iy*12000.0::DOUBLE AS y, -240000.0::DOUBLE + ix*12000.0::DOUBLE AS x,
           greatest(1.02::DOUBLE*(z/20.0::DOUBLE) + sqrt(x*x + y*y)*tan(8.0::DOUBLE*1.2::DOUBLE*pi()/180.0::DOUBLE), 6000.0::DOUBLE) AS roi,
           sqrt(x*x + y*y)/greatest(cos(radians(0.5::DOUBLE)), 0.01) AS s
    FROM (SELECT unnest(range(6)) AS iz) a, (SELECT unnest(range(41)) AS iy) b, (SELECT unnest(range(41)) AS ix) c) v
  WHERE NOT (sqrt(x*x + y*y + z*z) <= 3000)
    AND NOT (z < sqrt(s*s + {KR}*{KR} + 2*s*{KR}*sin(radians(0.5::DOUBLE))) - {KR} - 2400)""")

table("near", ("scan_xyz", "searched"), """
  SELECT v.voxel_id, g.gate_id, v.roi,
         (g.x - v.x)*(g.x - v.x) + (g.y - v.y)*(g.y - v.y) + (g.z - v.z)*(g.z - v.z) AS d2
  FROM searched v JOIN scan_xyz g
    ON (g.x - v.x)*(g.x - v.x) + (g.y - v.y)*(g.y - v.y) + (g.z - v.z)*(g.z - v.z) < v.roi*v.roi
  WHERE g.z <= 15000""")

table("map1", ("near",), """
  SELECT voxel_id, arg_min(gate_id, (floor(sqrt(d2)*262144), gate_id)) AS gate_id
  FROM near GROUP BY voxel_id""")

table("grid", ("map1", "gates"), """
  SELECT g.volume_id, m.voxel_id, CAST(m.voxel_id // 1681 AS INT) AS iz,
         CAST((m.voxel_id % 1681) // 41 AS INT) AS iy, CAST(m.voxel_id % 41 AS INT) AS ix,
         g.DBZH, g.DBZV, g.ZDR, g.RHOHV, g.PHIDP, g.KDP, g.VRAD, g.WRAD, g.elevation
  FROM gates g JOIN map1 m USING (gate_id)""")

table("vox", ("grid",), """
  SELECT volume_id, voxel_id, iz, iy, ix, DBZH AS value FROM grid
  WHERE NOT (coalesce(elevation < 0.65, false) OR coalesce(RHOHV < 0.8, false)
             OR coalesce(WRAD > 4.6, false) OR coalesce(ZDR > 8.5, false))""")

table("colmax", ("vox",), """
  SELECT volume_id, iy, ix, value FROM (
    SELECT volume_id, iy, ix, max(value) AS value FROM vox GROUP BY 1, 2, 3) q WHERE NOT value < -3""")

table("arrivals", (), """
  SELECT *, slot*21600 AS obs_s,
         radar || '_0315_' || vol_nr || '_' || field || '_' ||
         strftime(make_timestamp(slot*21600000000), '%Y%m%dT%H%M%SZ') || '.BUFR' AS filename
  FROM (SELECT event_id, ts AS created_ts, CAST(floor(epoch(ts)) AS BIGINT) AS created_s,
               'RAD' || CAST(user_id % 4 + 1 AS VARCHAR) AS radar, '0315' AS strategy,
               '0' || CAST((user_id // 4) % 2 + 1 AS VARCHAR) AS vol_nr,
               CASE event_type WHEN 'click' THEN 'DBZH' WHEN 'view' THEN 'DBZV' WHEN 'purchase' THEN 'ZDR'
                 WHEN 'signup' THEN 'RHOHV' ELSE 'KDP' END AS field,
               CAST(floor((floor(epoch(ts)) - floor(value)*60)/21600) AS BIGINT) AS slot,
               CASE WHEN value < 20 THEN 'failed' ELSE 'completed' END AS status,
               CAST(user_id % 3 AS INT) AS retry_count,
               CASE WHEN event_id % 11 = 0 THEN 'cleaned' WHEN event_id % 13 = 0 THEN 'cleanup_failed'
                 WHEN event_id % 2 = 0 THEN 'active' END AS cleanup_status
        FROM events) e
  WHERE NOT (field = 'KDP' AND slot % 5 = 0)""")

table("files", ("arrivals",), """
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY filename ORDER BY created_ts DESC, event_id DESC) AS rn
    FROM arrivals) q WHERE rn = 1""")

table("volumes", ("files",), """
  SELECT radar || '_' || strategy || '_' || vol_nr || '_' ||
         strftime(make_timestamp(obs_s*1000000), '%Y-%m-%dT%H:%M:%SZ') AS volume_id,
         radar, strategy, vol_nr, slot, obs_s,
         CASE slot % 4 WHEN 0 THEN 'completed' WHEN 1 THEN 'processing' WHEN 2 THEN 'pending' ELSE 'failed' END
           AS status,
         slot % 3 <> 1 AS is_complete,
         CASE WHEN slot % 6 <> 5 THEN '/volumes/' || radar END AS stored_path,
         CASE WHEN slot % 9 = 0 THEN 'cleaned' WHEN slot % 2 = 0 THEN 'active' END AS cleanup_status,
         obs_s + 7200 AS updated_s
  FROM (SELECT DISTINCT radar, strategy, vol_nr, slot, obs_s FROM files) k""")

table("products", ("volumes",), """
  SELECT volume_id, product_type, CASE phase WHEN 0 THEN 'completed' WHEN 1 THEN 'pending' ELSE 'failed' END AS status,
         CASE WHEN phase = 2 THEN 'GriddingError' END AS error_type,
         CASE WHEN phase = 0 THEN updated_s END AS generated_s, updated_s
  FROM (SELECT v.*, t.product_type,
               (slot + CASE WHEN t.product_type = 'image' THEN 0 ELSE slot % 2 END) % 3 AS phase
        FROM volumes v, (SELECT unnest(['image', 'raw_cog']) AS product_type) t WHERE slot % 7 <> 0) q""")

table("raw_sweeps", ("gates",), """
  SELECT volume_id, sweep, sweep*1.5::DOUBLE + 0.5::DOUBLE AS elevation,
         CAST(36 + CASE WHEN volume_id % 5 = 3 AND sweep = 2 THEN 1 ELSE 0 END AS INT) AS nrays, ngates,
         CAST(6000 - CASE WHEN volume_id % 7 = 6 AND sweep = 1 THEN 1000 ELSE 0 END AS INT) AS gate_size,
         CAST(3000 + (n % 3)*100 + CASE WHEN volume_id % 4 = 2 AND sweep = 4 THEN 2000 ELSE 0 END AS INT)
           AS gate_offset
  FROM (SELECT volume_id, sweep, max(gate) + 1 AS ngates, count(*) AS n FROM gates GROUP BY 1, 2) q""")

table("long_values", ("gates",), """
  SELECT volume_id, sweep, ray, gate, 'DBZH' AS field, DBZH AS value FROM gates UNION ALL
  SELECT volume_id, sweep, ray, gate, 'DBZV', DBZV FROM gates UNION ALL
  SELECT volume_id, sweep, ray, gate, 'ZDR', ZDR FROM gates UNION ALL
  SELECT volume_id, sweep, ray, gate, 'RHOHV', RHOHV FROM gates""")

table("field_scans", ("sweeps",), """
  SELECT volume_id, position, field, CASE WHEN field = 'DBZV' THEN 9000 ELSE 3000 END AS gate_offset,
         CASE WHEN field = 'ZDR' AND volume_id % 3 = 2 THEN 5000 ELSE 6000 END AS gate_size,
         CASE WHEN field = 'DBZV' AND volume_id % 2 = 0 THEN 39 ELSE 40 END AS ngates
  FROM (SELECT DISTINCT volume_id FROM sweeps) v,
       (VALUES (0, 'DBZH'), (1, 'DBZV'), (2, 'ZDR'), (3, 'RHOHV')) f(position, field)""")

table("alignment", ("field_scans",), """
  SELECT volume_id, field, ref_field, CAST(shift AS INT) AS shift,
         CASE WHEN gate_size <> ref_size THEN 'gate size differs'
              WHEN shift < 0 OR shift + ngates > ref_ngates THEN 'out of the reference range' END AS reason
  FROM (SELECT f.*, r.field AS ref_field, r.gate_size AS ref_size, r.ngates AS ref_ngates,
               floor((f.gate_offset - r.gate_offset)/r.gate_size) AS shift
        FROM field_scans f JOIN (SELECT *, row_number() OVER (PARTITION BY volume_id
          ORDER BY gate_offset + gate_size*ngates DESC, position) AS rn FROM field_scans) r
        ON r.volume_id = f.volume_id AND r.rn = 1) q""")

table("presence", ("sweeps",), """
  SELECT volume_id, unnest(CASE volume_id % 3 WHEN 0 THEN ['DBZH','DBZV','TH','RHOHV','KDP']
    WHEN 1 THEN ['TH','TV','TDR','PHIDP'] ELSE ['DBZH','ZDR','VRAD','WRAD','CM'] END) AS field
  FROM (SELECT DISTINCT volume_id FROM sweeps) v""")

table("sites", ("sweeps",), """
  SELECT DISTINCT volume_id, (volume_id % 4)*0.7::DOUBLE - 64.2::DOUBLE AS site_lon,
         (volume_id % 4)*0.3::DOUBLE - 31.4::DOUBLE AS site_lat FROM sweeps""")


def components(name: str, mask: str, width: int, wrap_rows: int | None = None) -> None:
    """Register ``name`` (img, p, label): four-connected components of a mask (img, r, c)."""
    below = f"(a.r + 1) % {wrap_rows}" if wrap_rows else "a.r + 1"
    table(f"{name}_edges", (mask,), f"""
      WITH one AS (
        SELECT a.img, a.r*{width} + a.c AS p, b.r*{width} + b.c AS q
        FROM {mask} a JOIN {mask} b ON b.img = a.img AND b.r = a.r AND b.c = a.c + 1
        UNION ALL
        SELECT a.img, a.r*{width} + a.c, b.r*{width} + b.c
        FROM {mask} a JOIN {mask} b ON b.img = a.img AND b.c = a.c AND b.r = {below})
      SELECT img, p, q FROM one UNION ALL SELECT img, q, p FROM one""")  # fmt: skip
    table(name, (mask, f"{name}_edges"), f"""
      SELECT img, r*{width} + c, r*{width} + c FROM {mask}
      UNION
      SELECT e.img, e.q, min(l.label) FROM {name} l JOIN {name}_edges e ON e.img = l.img AND e.p = l.p
      JOIN recurring.{name} k ON k.img = e.img AND k.p = e.q
      WHERE l.label < k.label GROUP BY e.img, e.q""", head=f"{name}(img, p, label) USING KEY (img, p) AS")  # fmt: skip


table("stage3", ("gates",), """
  SELECT *, volume_id*100 + sweep AS img, ray AS r, gate AS c FROM gates WHERE NOT (
    ((coalesce(DBZH < -3, true) OR coalesce(RHOHV < 0.55, true) OR coalesce(ZDR > 8.5, true)
      OR coalesce(WRAD > 4.6, true)) AND NOT coalesce(DBZH > 25, false))
    OR (coalesce(CM = 1, false) AND NOT coalesce(RHOHV > 0.85, false)))""")
components("speckle3", "stage3", 40, 36)

table("good_rhohv", ("gates",), """
  SELECT *, volume_id*100 + sweep AS img, ray AS r, gate AS c FROM gates WHERE NOT coalesce(RHOHV < 0.75, false)""")
components("speckle1", "good_rhohv", 40, 36)

# The same map for every volume as a geometry of its own.
table("vol", (), "SELECT DISTINCT l_suppkey // 25 AS volume_id FROM lineitem")


def surface(source: str, elevation: str, value: str = "value", curved: bool = True) -> str:
    """Linear beam-surface slice of (volume_id, iz, iy, ix, value) rows of a source."""
    s = f"(d/greatest(cos(radians({elevation})), 0.01))"
    t = f"sqrt({s}*{s} + {KR}*{KR} + 2*{s}*{KR}*sin(radians({elevation}))) - {KR}"
    if not curved:
        t = f"d*tan(radians({elevation}))"
    return f"""SELECT volume_id, iy, ix, coalesce((1 - w)*a + w*b, a, b) AS value FROM (
      SELECT volume_id, iy, ix, max(f - lo) AS w, max(CASE WHEN iz = lo THEN {value} END) AS a,
             max(CASE WHEN iz = least(lo + 1, 5) THEN {value} END) AS b
      FROM (SELECT *, floor(f) AS lo FROM (SELECT *, ({t})/3000.0::DOUBLE AS f, {t} AS t FROM (SELECT *,
        sqrt((-240000.0::DOUBLE + ix*12000.0::DOUBLE)*(-240000.0::DOUBLE + ix*12000.0::DOUBLE)
           + (-240000.0::DOUBLE + iy*12000.0::DOUBLE)*(-240000.0::DOUBLE + iy*12000.0::DOUBLE)) AS d
        FROM {source}) q0) q1) q2
      WHERE t >= 0 AND t <= 15000 AND (iz = lo OR iz = least(lo + 1, 5)) GROUP BY ALL) q3
      WHERE coalesce(a, b) IS NOT NULL"""
