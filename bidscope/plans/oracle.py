"""SQL text shared by the DuckDB oracles.

``CONTRACTS`` is the contract view written independently in SQL over the
driver tables (same mapping as ``sources.tables.contracts``).  Every numeric
literal is cast to DOUBLE so both engines do double arithmetic.
"""

CONTRACTS_SELECT = """
SELECT
  CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) || '-' ||
  CAST(l.l_partkey AS VARCHAR) || '-' || CAST(l.l_suppkey AS VARCHAR) AS uid,
  CAST(o.o_custkey AS VARCHAR) AS acheteur_id,
  CAST(o.o_custkey AS VARCHAR) AS acheteur_siren,
  CAST(c.c_nationkey AS VARCHAR) AS acheteur_region,
  CAST(s.s_nationkey AS VARCHAR) AS titulaire_id,
  CAST(l.l_suppkey AS VARCHAR) AS titulaire_siren,
  l.l_extendedprice * l.l_quantity * (CAST(1 AS DOUBLE) - l.l_discount) AS montant,
  CAST(CASE WHEN CAST(substr(p.p_brand, 7) AS INTEGER) = 25 THEN 71
            ELSE 44 + CAST(substr(p.p_brand, 7) AS INTEGER) END AS VARCHAR)
    || lpad(CAST(p.p_size AS VARCHAR), 2, '0')
    || lpad(CAST(p.p_partkey % 10000 AS VARCHAR), 4, '0')
    || '-' || CAST(p.p_partkey % 10 AS VARCHAR) AS codeCPV,
  CASE o.o_orderpriority
    WHEN '5-LOW' THEN 'Appel d''offres ouvert'
    WHEN '4-NOT SPECIFIED' THEN 'Appel d''offres restreint'
    WHEN '3-MEDIUM' THEN 'Procédure adaptée'
    WHEN '2-HIGH' THEN 'Marché négocié sans publicité'
    ELSE 'Procédure avec négociation' END AS procedure,
  p.p_type AS categorie,
  CASE WHEN l.l_linenumber = 7 THEN NULL
       WHEN p.p_size <= 2 THEN CAST(p.p_size AS DOUBLE) * CAST(0.25 AS DOUBLE)
       ELSE CAST(p.p_size AS DOUBLE) END AS dureeMois,
  CASE WHEN l.l_linenumber = 6 THEN NULL ELSE CAST(l.l_linenumber AS DOUBLE) END AS offresRecues,
  CASE WHEN l.l_tax = CAST(0.08 AS DOUBLE) THEN NULL ELSE l.l_tax * CAST(4 AS DOUBLE) END AS tauxAvance,
  CASE l.l_returnflag WHEN 'R' THEN CAST(1 AS DOUBLE) WHEN 'A' THEN CAST(0 AS DOUBLE) END
    AS sousTraitanceDeclaree,
  CASE WHEN o.o_orderkey % 4 = 0 THEN CAST(o.o_orderkey AS VARCHAR) END AS idAccordCadre,
  l.l_linestatus AS nature,
  c.c_mktsegment AS formePrix,
  split_part(p.p_name, ' ', 1) AS ccag,
  o.o_orderstatus AS typeGroupementOperateurs,
  CASE WHEN s.s_nationkey % 5 = 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS origineFrance,
  CASE WHEN p.p_size % 7 = 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS marcheInnovant,
  CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR) AS dateNotification
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN part p ON l.l_partkey = p.p_partkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
"""

CPV_CODES_SELECT = """
SELECT DISTINCT code AS CODE, 'Libellé ' || code AS FR FROM (
  SELECT CAST(CASE WHEN CAST(substr(p_brand, 7) AS INTEGER) = 25 THEN 71
                   ELSE 44 + CAST(substr(p_brand, 7) AS INTEGER) END AS VARCHAR)
         || lpad(CAST(p_size AS VARCHAR), 2, '0')
         || lpad(CAST(p_partkey % 10000 AS VARCHAR), 4, '0')
         || '-' || CAST(p_partkey % 10 AS VARCHAR) AS code
  FROM part) t
WHERE NOT code LIKE '%-3'
"""

REGISTRY_SELECT = """
SELECT 'B' || CAST(c_custkey AS VARCHAR) AS siren, c_mktsegment AS categorieEntreprise,
       lpad(CAST(c_custkey % 54 AS VARCHAR), 2, '0') AS trancheEffectifsUniteLegale
FROM customer
UNION ALL
SELECT 'S' || CAST(s_suppkey AS VARCHAR),
       CASE WHEN s_nationkey % 3 = 0 THEN 'PME' WHEN s_nationkey % 3 = 1 THEN 'ETI' ELSE 'GE' END,
       lpad(CAST(s_suppkey % 54 AS VARCHAR), 2, '0')
FROM supplier
"""


def cpv_level_sql(col: str, level: int) -> str:
    return (f"rpad(substr(split_part(trim({col}), '-', 1) || '00000000', 1, {level}), 8, '0')")


def md5_u_sql(expr: str) -> str:
    """Uniform [0,1) from an md5 hex string expression."""
    return f"(CAST(('0x' || substr({expr}, 1, 7)) AS BIGINT) / CAST(268435456 AS DOUBLE))"


def md5_sql(*parts: str, seed) -> str:
    inner = " || ':' || ".join([f"CAST({p} AS VARCHAR)" for p in parts] + [f"'{seed}'"])
    return f"md5({inner})"


def with_contracts(body: str, extra: str = "") -> str:
    """``WITH contracts AS (...) [, extra] body``"""
    ctes = f"WITH contracts AS ({CONTRACTS_SELECT})"
    if extra:
        ctes += ",\n" + extra
    return ctes + "\n" + body
