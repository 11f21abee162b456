"""Survey-like views derived from the test tables by fixed arithmetic.

``VIEWS[name]`` is a one- or two-element tuple: the Spark text and, where the dialects differ,
the SQL counterpart. ``SEQ[a,b,step]`` is one row per number from a to b.
"""

from __future__ import annotations

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

VIEWS: dict[str, tuple[str, ...]] = {
    "target": (
        """SELECT vec_id + 1 AS target_id, concat('OBJ_', CAST(FLOOR(vec_id / 3e0) AS BIGINT)) AS cname,
           concat('T', vec_id) AS targid,
           CASE WHEN label IN (6, 9) THEN 'DEEP' ELSE 'DISC' END AS targsrvy,
           CASE WHEN label <= 2 THEN 'STAR' WHEN label = 3 THEN 'WD' WHEN label <= 5 THEN 'QSO'
                WHEN label <= 8 THEN 'ELG' ELSE '' END AS targclass,
           CASE WHEN vec_id % 17 = 0 THEN 'P' ELSE 'A' END AS status,
           CASE vec_id % 3 WHEN 0 THEN 'T' WHEN 1 THEN 'C' ELSE 'S' END AS targuse,
           150e0 + (vec_id * 37 % 400) / 4000e0 AS ra, 2e0 + (vec_id * 53 % 400) / 4000e0 AS dec
           FROM {embeddings}""",
    ),
    "px0": (
        "SELECT vec_id, pix, element_at(embedding, pix + 1) AS v FROM (SELECT *, explode(sequence(0, 63)) AS pix FROM {embeddings})",
        "SELECT vec_id, pix, embedding[pix + 1] AS v FROM (SELECT *, unnest(range(64)) AS pix FROM {embeddings}) AS e",
    ),
    "pixel": (
        """SELECT vec_id AS spec_id, arm, CAST(pix AS INT) AS pix, 4000e0 + 10e0 * pix AS wave,
           CASE WHEN (vec_id + pix) % 41 = 0 THEN NULL
                ELSE (2e0 + CAST(v AS DOUBLE)) * CASE WHEN arm = 'RED' THEN 0.9e0 ELSE 1e0 END END AS flux,
           CASE WHEN (vec_id * 31 + pix) % 23 = 0 THEN 0e0
                ELSE 25e0 + (vec_id * 7 + pix * 13) % 10 END AS ivar
           FROM (SELECT vec_id, pix, v, 'BLUE' AS arm FROM {px0} WHERE pix < 36
                 UNION ALL SELECT vec_id, pix, v, 'RED' AS arm FROM {px0} WHERE pix >= 28) AS p""",
    ),
    "arm_meta": (
        """SELECT spec_id, arm,
           CASE WHEN sum(CASE WHEN ivar > 0 THEN 1 ELSE 0 END) * 2 >= count(*)
                THEN avg(CASE WHEN ivar > 0 THEN flux * sqrt(ivar) END) END AS snr,
           sum(CASE WHEN ivar > 0 AND flux IS NOT NULL THEN 1 ELSE 0 END) AS n_good
           FROM {pixel} GROUP BY spec_id, arm""",
    ),
    # One brightness-weighted class per spectrum, used to group spectra.
    "spec_class": ("SELECT vec_id AS spec_id, label AS grp FROM {embeddings}",),
    "zfit": (
        """SELECT target_id, znum, z, zerr, zwarn, class, chi2 FROM (
           SELECT l_orderkey AS target_id,
           CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice, l_partkey, l_suppkey, l_linenumber, l_shipdate) - 1 AS INT) AS znum,
           l_discount * 10 AS z, l_tax / 100 AS zerr,
           CASE l_returnflag WHEN 'N' THEN 0 WHEN 'A' THEN 4 ELSE 1024 END AS zwarn,
           CASE l_partkey % 3 WHEN 0 THEN 'STAR' WHEN 1 THEN 'GALAXY' ELSE 'QSO' END AS class,
           l_extendedprice AS chi2
           FROM {lineitem}) AS q""",
    ),
    "zhint": (
        """SELECT o_orderkey AS target_id,
           CASE o_custkey % 4 WHEN 0 THEN 'STAR' WHEN 1 THEN 'QSO' WHEN 2 THEN 'ELG' ELSE '' END AS targclass,
           o_orderpriority AS targprog, CASE WHEN o_orderkey % 2 = 0 THEN 'DEEP' ELSE 'DISC' END AS targsrvy
           FROM {orders}""",
    ),
    "zscan": (
        """SELECT user_id AS target_id,
           CASE event_type WHEN 'click' THEN 'STAR' WHEN 'view' THEN 'GALAXY' WHEN 'purchase' THEN 'QSO'
                WHEN 'error' THEN 'STAR:::2' ELSE 'GALAXY:::2' END AS template,
           event_id AS i, value / 500e0 AS z,
           100e0 + (value - 60) * (value - 60) / 50e0 + event_id % 7 AS chi2 FROM {events}""",
    ),
    "merge_a": ("SELECT c_custkey AS target_id, c_acctbal AS v_a, c_mktsegment AS s_a FROM {customer}",),
    "merge_b": ("SELECT s_suppkey AS target_id, s_acctbal AS v_b, s_nationkey AS n_b FROM {supplier}",),
    "merge_c": ("SELECT p_partkey AS target_id, p_retailprice AS v_c, p_size AS n_c FROM {part}",),
    "spaxel": (
        """SELECT *, signal / noise AS snr FROM (
           SELECT p_partkey AS target_id, CAST(FLOOR(p_partkey / 500e0) AS BIGINT) AS field,
           p_partkey % 50 AS ix, CAST(FLOOR(p_partkey / 50e0) AS BIGINT) AS iy,
           (p_partkey % 50 - 25) * 0.5e0 AS x, (FLOOR(p_partkey / 50e0) - 20) * 0.5e0 AS y,
           (p_retailprice / 100e0 - 8e0) * 10e0 AS signal, 1e0 + p_size / 10e0 AS noise FROM {part}) AS s""",
    ),
    # Bins of 2x2 spaxels, numbered from 1; spaxels below an SNR of 3 lie outside and carry a negative number.
    "binmap": (
        """SELECT *, CASE WHEN snr >= 3 THEN bin_raw ELSE -bin_raw END AS bin_id FROM (
           SELECT *, CAST(1 + FLOOR(ix / 2e0) + 25 * FLOOR(iy / 2e0) AS BIGINT) AS bin_raw FROM {spaxel}) AS b""",
    ),
    "bin_result": (
        """SELECT bin_raw AS bin_id, (bin_raw * 37 % 200) - 100e0 AS v, 50e0 + bin_raw * 13 % 80 AS sigma,
           (bin_raw % 11 - 5) / 50e0 AS h3 FROM (SELECT DISTINCT bin_raw FROM {binmap}) AS b""",
    ),
    # Cubes of 1,500 orders each, 7 channels by 25 by 40 pixels: their number grows with the table.
    "voxel": (
        """SELECT cube_id, iw, iy, ix, data, ivar, data * sqrt(ivar) AS snr FROM (
           SELECT CAST(FLOOR(l_orderkey / 1500e0) AS BIGINT) AS cube_id, CAST(l_linenumber AS BIGINT) AS iw, l_suppkey % 25 AS iy, l_partkey % 40 AS ix,
           avg(l_quantity) - 25e0 AS data, count(*) / 200e0 AS ivar
           FROM {lineitem} GROUP BY CAST(FLOOR(l_orderkey / 1500e0) AS BIGINT), l_linenumber, l_suppkey % 25, l_partkey % 40) AS v""",
    ),
    # Ten objects to a cube, a few of them bright enough to cover their surroundings.
    "object": (
        """SELECT s_suppkey AS obj_id, CAST(FLOOR(s_suppkey / 10e0) AS BIGINT) AS cube_id, CAST(s_suppkey * 7 % 40 AS DOUBLE) AS ox, CAST(s_suppkey * 11 % 25 AS DOUBLE) AS oy,
           1e0 + s_suppkey % 3 AS a, 1e0 AS b, s_acctbal AS flux FROM {supplier}""",
    ),
    "cat_a": (
        """SELECT c_custkey AS id, 10e0 + (c_custkey * 7919 % 10007) / 200000e0 AS ra,
           20e0 + (c_custkey * 104729 % 10009) / 200000e0 AS dec FROM {customer}""",
    ),
    "cat_b": (
        """SELECT s_suppkey AS id, 10e0 + (s_suppkey * 13 * 7919 % 10007) / 200000e0 AS ra,
           20e0 + (s_suppkey * 13 * 104729 % 10009) / 200000e0 + s_suppkey % 5 * 0.0001e0 AS dec FROM {supplier}""",
    ),
    "ephemeris": (
        """SELECT id, ra, dec, 2450000e0 + id AS epoch, 0.4e0 + id / 1000e0 AS period, 0.5e0 + id / 200e0 AS amp
           FROM {cat_b}""",
    ),
    "curve": (
        """SELECT nspec, CAST(w AS DOUBLE) AS wave, 2e0 + bal / 10000e0 + w / 10000e0 AS value FROM (
           SELECT s_suppkey AS nspec, s_acctbal AS bal, SEQ[4000,4630,30] AS w FROM {supplier}) AS c""",
    ),
    # Every seventh fibre has no curve: for operators that stand in for missing ones.
    "curve_gaps": ("SELECT * FROM {curve} WHERE nspec % 7 <> 3",),
    "arc": (
        """SELECT user_id AS nspec, 4000e0 + value AS wave,
           2e0 + (event_id % 97) / 50e0 + CASE WHEN event_id % 211 = 0 THEN 5e0 ELSE 0e0 END AS fwhm,
           CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS fit_flag,
           CASE WHEN user_id % 19 <> 0 THEN 1 ELSE 0 END AS live, event_id AS point_id FROM {events}""",
    ),
    "prov": (
        "SELECT CAST(FLOOR(p_partkey / 4e0) AS BIGINT) AS parent, p_partkey AS child, p_partkey AS ord FROM {part} WHERE p_partkey > 0",
    ),
    "lines_long": (
        """SELECT l_suppkey AS bin_id, CAST(l_linenumber AS BIGINT) AS line, avg(l_extendedprice) - 50000e0 AS flux,
           avg(l_quantity) / 5e0 - 3e0 + l_suppkey % 9 AS aon, avg(l_discount) * 1000e0 AS v, avg(l_tax) * 1000e0 AS sigma
           FROM {lineitem} GROUP BY l_suppkey, l_linenumber""",
    ),
    "line_wide": (
        "SELECT bin_id, "
        + ", ".join(
            f"max(CASE WHEN line = {n} THEN {q} END) AS {q.upper()}_L{n}" for q in ("flux", "aon", "v", "sigma") for n in range(1, 8)
        )
        + " FROM {lines_long} GROUP BY bin_id",
    ),
    "job": (
        """SELECT event_id AS job_id, concat(event_type, '_', user_id) AS name,
           CASE event_id % 6 WHEN 0 THEN 'TIMEOUT' WHEN 1 THEN 'FAILED' WHEN 2 THEN 'COMPLETED'
                WHEN 3 THEN 'CANCELLED by 1000' WHEN 4 THEN 'OUT_OF_MEMORY' ELSE 'RUNNING' END AS state,
           event_type AS stage FROM {events}""",
    ),
    "flagrow": ("SELECT o_orderkey AS id, o_orderkey * 2654435761 % 1048576 AS flags FROM {orders}",),
    "manifest_a": (
        "SELECT concat(source, '/', doc_id) AS path, source AS component, n_chars AS size, md5(text) AS hash FROM {documents}",
    ),
    "manifest_b": (
        """SELECT concat(source, '/', doc_id) AS path, source AS component,
           n_chars + CASE WHEN doc_id % 10 = 7 THEN 1 ELSE 0 END AS size, md5(text) AS hash
           FROM {documents} WHERE doc_id % 10 <> 3
           UNION ALL SELECT concat('new/', doc_id) AS path, 'new' AS component, n_chars AS size, md5(text) AS hash
           FROM {documents} WHERE doc_id % 50 = 1""",
    ),
    "exposure": (
        """SELECT o_orderkey AS file_id, concat(CASE o_orderkey % 4 WHEN 0 THEN 'single' WHEN 1 THEN 'stack'
             WHEN 2 THEN 'superstack' ELSE 'obj_' END, '_', o_orderkey) AS file,
           o_custkey AS cname, CASE o_orderstatus WHEN 'P' THEN 'BLUE' WHEN 'F' THEN 'GREEN' ELSE 'RED' END AS arm,
           CASE WHEN o_custkey % 2 = 0 THEN 'FIBRE' ELSE 'CUBE' END AS mode,
           CASE WHEN o_totalprice > 150000 THEN 'HIGH' ELSE 'LOW' END AS resolution,
           CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN 'DEEP' WHEN 2 THEN 'DISC' ELSE 'WIDE' END AS survey,
           o_totalprice AS wmin, o_totalprice + 1000 AS wmax FROM {orders}""",
    ),
    "candidate": (
        """SELECT event_id AS id, user_id AS target_id, value / 490.02e0 AS prob,
           CASE WHEN event_id % 9 = 0 THEN 1 ELSE 0 END AS duplicated FROM {events}""",
    ),
}
