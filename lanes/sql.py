"""SQL building blocks for DuckDB: every function returns CTE text, chained with commas."""

from __future__ import annotations

RUN = "ID_Analyte, ID_Rep, IsotopeLabelType"
FRAG = "ID_FragmentIon_charge"
CELL = f"{RUN}, {FRAG}"
PLACE = f"row_number() OVER (PARTITION BY ID_Analyte ORDER BY rank_similarity, Rank NULLS LAST, {FRAG})"

# `ex`: one row per cell of the derived export. `pt`: one row per cell and point.
EXPORT = """
WITH RECURSIVE cell AS (
  SELECT l_partkey, l_returnflag, l_linestatus, l_linenumber,
         round(sum(l_extendedprice), 2) AS area, max(l_quantity) AS lib,
         round(avg(l_discount) * 140, 9) AS err,
         sum(l_orderkey) % 5 - 2 AS shift, sum(l_suppkey) % 3 + 2 AS width
  FROM lineitem GROUP BY 1, 2, 3, 4),
raw AS (
  SELECT p_brand AS ProteinName, p_name || '-' || l_partkey AS PeptideModifiedSequence,
         l_linestatus AS IsotopeLabelType, p_type = 'ECONOMY' AS IsDecoy,
         CAST(p_size % 2 + 2 AS BIGINT) AS PrecursorCharge,
         CAST(l_linenumber % 2 + 1 AS BIGINT) AS ProductCharge,
         CAST(CASE WHEN l_linenumber % 2 = 0 THEN p_size * 10 + l_linenumber * 7
                   WHEN l_linestatus = 'F' THEN p_size * 10 + l_linenumber * 7 + 4
                   ELSE p_size * 10 + l_linenumber * 7 END AS DOUBLE) AS ProductMz,
         CASE WHEN l_linenumber = 7 THEN 'precursor [M+1]'
              WHEN l_linenumber % 2 = 0 THEN 'b' || l_linenumber
              ELSE 'y' || l_linenumber END AS FragmentIon,
         't/' || l_partkey || '/' || l_linenumber AS TransitionLocator,
         'run_' || l_returnflag || '.raw' AS FileName,
         CAST(CASE WHEN l_partkey % 97 <> 0 THEN CASE WHEN l_partkey % 89 = 0 THEN 10.5
              WHEN l_linestatus = 'F' THEN 10.2 ELSE 10.3 END END AS DOUBLE) AS MinStartTime,
         CAST(CASE WHEN l_partkey % 97 <> 0 THEN CASE WHEN l_partkey % 89 = 0 THEN 10.5
              ELSE 10.8 END END AS DOUBLE) AS MaxEndTime,
         area AS Area, lib AS LibraryIntensity,
         'p/' || l_partkey || '/' || l_returnflag || '/' || l_linestatus AS PrecursorResultLocator,
         err, shift, width
  FROM cell JOIN part ON l_partkey = p_partkey),
ex AS MATERIALIZED (
  SELECT *,
         substr(sha256(ProteinName || '_' || PeptideModifiedSequence || '_' || PrecursorCharge
                || CASE WHEN IsDecoy THEN 'True' ELSE 'False' END), 1, 8) AS ID_Analyte,
         substr(sha256(FragmentIon || '_' || ProductCharge), 1, 8) AS ID_FragmentIon_charge,
         substr(sha256(FileName), 1, 8) AS ID_Rep
  FROM raw),
pt AS MATERIALIZED (
  SELECT ID_Analyte, ID_Rep, IsotopeLabelType, ID_FragmentIon_charge, MinStartTime, MaxEndTime, Area,
         LibraryIntensity, k, round(10 + k * CAST(0.1 AS DOUBLE), 4) AS t,
         greatest(CAST(0.0 AS DOUBLE), area * greatest(CAST(-0.05 AS DOUBLE),
                  1 - CAST((k - 5 - shift) * (k - 5 - shift) AS DOUBLE) / (width * width))) AS y,
         err * (1 + CAST(0.1 AS DOUBLE) * (k - 5)) * CASE WHEN k % 2 = 1 THEN -1 ELSE 1 END AS e
  FROM ex, range(11) AS r(k))"""


# The same from suppliers, with up to 14 fragments per analyte.
WIDE = """
WITH RECURSIVE wide AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS ID_Analyte, l_returnflag AS ID_Rep, l_linestatus AS IsotopeLabelType,
         's' || lpad(CAST(l_linenumber * 2 + l_partkey % 2 AS VARCHAR), 2, '0') AS ID_FragmentIon_charge,
         round(sum(l_extendedprice), 2) AS Area, max(l_quantity) AS LibraryIntensity, round(avg(l_discount) * 100, 9) AS err,
         sum(l_orderkey) % 5 - 2 AS shift, sum(l_partkey) % 3 + 2 AS width
  FROM lineitem GROUP BY 1, 2, 3, 4),
pt AS MATERIALIZED (
  SELECT ID_Analyte, ID_Rep, IsotopeLabelType, ID_FragmentIon_charge, CAST(10.2 AS DOUBLE) AS MinStartTime,
         CAST(10.8 AS DOUBLE) AS MaxEndTime, Area, LibraryIntensity, k, round(10 + k * CAST(0.1 AS DOUBLE), 4) AS t,
         greatest(CAST(0.0 AS DOUBLE), Area * (1 - CAST((k - 5 - shift) * (k - 5 - shift) AS DOUBLE) / (width * width))) AS y,
         err AS e
  FROM wide, range(11) AS r(k))"""


def group_sql(key: str, n: int) -> str:
    """Equal-width bucket of the first two hex characters, order a-f then 0-9."""
    digit = lambda at: f"(instr('abcdef0123456789', substr({key}, {at}, 1)) - 1)"
    return f"CAST(greatest(1, ceil(({digit(1)} * 16 + {digit(2)}) * {n} / 255.0)) AS BIGINT)"


def zones(points: str = "pt", s: str = "") -> str:
    """`zn`: the in-zone points of every usable run."""
    return f"""
zr{s} AS (SELECT DISTINCT {RUN}, k, t, CASE WHEN round(t, 5) BETWEEN round(MinStartTime, 5)
            AND round(MaxEndTime, 5) THEN 1 ELSE 0 END AS z
          FROM {points} WHERE MinStartTime IS NOT NULL AND MaxEndTime IS NOT NULL),
zc{s} AS (SELECT *, sum(z) OVER r AS nz, min(CASE WHEN z = 1 THEN k END) OVER r AS k1
          FROM zr{s} WINDOW r AS (PARTITION BY {RUN})),
zn{s} AS MATERIALIZED (
  SELECT {RUN}, k, t, CASE WHEN z = 1 OR (nz = 1 AND k = CASE WHEN k1 = 0 THEN 1 ELSE k1 - 1 END)
         THEN 1 ELSE 0 END AS z FROM zc{s} WHERE nz > 0)"""


def cells(points: str = "pt", s: str = "") -> str:
    """`cx`: normalised in-zone points; `ce`: one row per cell with its mass error; `rf`: library
    intensity, rank and mean area."""
    return zones(points, s) + f""",
cz{s} AS (SELECT p.*, max(y) OVER (PARTITION BY {', '.join('p.' + c for c in CELL.split(', '))}) AS top
          FROM {points} p JOIN zn{s} z USING ({RUN}, k) WHERE z.z = 1),
cx{s} AS MATERIALIZED (
  SELECT {CELL}, k, CASE WHEN top > 0 THEN y / top * 100 END AS x, e, Area, LibraryIntensity FROM cz{s}),
cm{s} AS (SELECT {CELL}, any_value(Area) AS Area, any_value(LibraryIntensity) AS LibraryIntensity,
          CASE WHEN sum(x) > 0 THEN sum(abs(e) * x) / sum(x) END AS mean_err FROM cx{s} GROUP BY {CELL}),
ce{s} AS MATERIALIZED (
  SELECT *, CASE WHEN mean_err <= 5 THEN 1.0 WHEN mean_err <= 10 THEN 2.0 - mean_err / 5.0
            WHEN mean_err IS NOT NULL THEN 0.0 END::DOUBLE AS err_score FROM cm{s}),
fr{s} AS (SELECT ID_Analyte, min(struct_pack(f := {FRAG}, r := ID_Rep, l := IsotopeLabelType)) AS m
          FROM ce{s} GROUP BY 1),
lb{s} AS MATERIALIZED (
  SELECT ID_Analyte, {FRAG}, LibraryIntensity AS lib,
         rank() OVER (PARTITION BY ID_Analyte ORDER BY LibraryIntensity DESC NULLS LAST) AS Rank
  FROM ce{s} JOIN fr{s} USING (ID_Analyte) WHERE ID_Rep = m.r AND IsotopeLabelType = m.l),
pr{s} AS MATERIALIZED (SELECT ID_Analyte, IsotopeLabelType, {FRAG}, avg(Area) AS mean_area
          FROM ce{s} GROUP BY 1, 2, 3)"""


def everything(name: str, s: str = "") -> str:
    """All fragments of every analyte as a subset, with the number of fragments of the analyte."""
    return f"""
{name} AS MATERIALIZED (SELECT DISTINCT ID_Analyte, {FRAG}, TRUE AS in_set FROM ce{s})"""


def rows(name: str, members: str, comment: str, s: str = "") -> str:
    """Similarity of every base fragment to the summed trace of the subset, per run."""
    return f"""
{name}_t AS (SELECT {RUN}, k, sum(x) AS tot FROM cx{s} JOIN {members} USING (ID_Analyte, {FRAG})
             WHERE in_set GROUP BY {RUN}, k),
{name}_n AS (SELECT {RUN}, sum(tot * tot) AS tt FROM {name}_t GROUP BY {RUN}),
{name}_d AS (SELECT {CELL}, sum(x * tot) AS xt, sum(x * x) AS xx FROM cx{s}
             JOIN {members} USING (ID_Analyte, {FRAG}) LEFT JOIN {name}_t USING ({RUN}, k) GROUP BY {CELL}),
{name} AS MATERIALIZED (
  SELECT ce{s}.*, lib, in_set, {comment} AS Comment,
         CASE WHEN xx * tt > 0 THEN least(1.0, coalesce(xt, 0) / sqrt(xx * tt)) END AS similarity
  FROM ce{s} JOIN {members} USING (ID_Analyte, {FRAG}) LEFT JOIN {name}_d USING ({CELL})
  LEFT JOIN {name}_n USING ({RUN}) LEFT JOIN lb{s} USING (ID_Analyte, {FRAG}))"""


def classified(name: str, source: str, s: str = "") -> str:
    return f"""
{name}_q AS (
  SELECT ID_Analyte, {FRAG}, quantile_cont(round(similarity, 9), 0.25) AS q25_similarity,
         quantile_cont(Area, 0.25) AS q25_area, quantile_cont(mean_err, 0.5) AS median_error
  FROM {source} GROUP BY 1, 2),
{name} AS MATERIALIZED (
  SELECT q.*, Rank,
         rank() OVER (PARTITION BY q.ID_Analyte ORDER BY round(q25_similarity, 9) DESC NULLS LAST) AS rank_similarity,
         rank() OVER (PARTITION BY q.ID_Analyte ORDER BY round(q25_area, 9) DESC NULLS LAST) AS rank_area
  FROM {name}_q q LEFT JOIN lb{s} USING (ID_Analyte, {FRAG}))"""


def surviving(name: str, source: str, error_cut: bool) -> str:
    cut = "AND coalesce(median_error < 10, TRUE)" if error_cut else ""
    return f"""
{name}_w AS MATERIALIZED (
  SELECT *, count(*) OVER (PARTITION BY ID_Analyte) AS n,
         row_number() OVER (PARTITION BY ID_Analyte
           ORDER BY rank_similarity DESC, Rank DESC NULLS LAST, {FRAG}) AS nth FROM {source}),
{name} AS MATERIALIZED (
  SELECT ID_Analyte, {FRAG}, TRUE AS in_set, {PLACE} AS place FROM {name}_w
  WHERE nth > greatest(0, least(floor(n * 0.25), n - 3)) {cut})"""


def placed(name: str, source: str) -> str:
    """All fragments of a classification, by place."""
    return f"""
{name} AS MATERIALIZED (SELECT ID_Analyte, {FRAG}, TRUE AS in_set, {PLACE} AS place FROM {source})"""


def _scored(name: str, kept: str, s: str = "") -> str:
    """`name_s`: the score of every subset of the kept fragments; the first fragment is the highest bit."""
    return f"""
{name}_c AS (SELECT ID_Analyte, {FRAG}, place, row_number() OVER (PARTITION BY ID_Analyte ORDER BY {FRAG} DESC) - 1 AS c,
             count(*) OVER (PARTITION BY ID_Analyte) AS kk FROM {kept}),
{name}_m AS (SELECT a.ID_Analyte, m FROM (SELECT DISTINCT ID_Analyte, kk FROM {name}_c) a, range(1, 128) AS r(m)
             WHERE m < (1 << kk) AND bit_count(m) >= least(3, kk)),
{name}_x AS (SELECT x.*, c FROM cx{s} x JOIN {name}_c USING (ID_Analyte, {FRAG})),
{name}_g AS MATERIALIZED (SELECT a.ID_Analyte, a.ID_Rep, a.IsotopeLabelType, a.c, b.c AS d,
             coalesce(sum(a.x * b.x), 0) AS g FROM {name}_x a JOIN {name}_x b USING ({RUN}, k) GROUP BY ALL),
{name}_o AS (SELECT {RUN}, c, g AS own FROM {name}_g WHERE c = d),
{name}_p AS (SELECT {RUN}, m, sum(g) AS q, sum(CASE WHEN own > 0 THEN g / sqrt(own) ELSE 0 END) AS r
             FROM {name}_g JOIN {name}_o USING ({RUN}, c) JOIN {name}_m USING (ID_Analyte)
             WHERE (m >> c) & 1 = 1 AND (m >> d) & 1 = 1 GROUP BY {RUN}, m),
{name}_l AS (SELECT {RUN}, m, count(*) AS n, sum(coalesce(err_score, 0)) AS e, sum(Area * Area) AS aa,
             sum(coalesce(Area * lib, 0)) AS al, sum(coalesce(lib * lib, 0)) AS ll,
             sum(Area * mean_area) AS ap, sum(mean_area * mean_area) AS pp
             FROM ce{s} JOIN {name}_c USING (ID_Analyte, {FRAG}) LEFT JOIN lb{s} USING (ID_Analyte, {FRAG})
             JOIN pr{s} USING (ID_Analyte, IsotopeLabelType, {FRAG}) JOIN {name}_m USING (ID_Analyte)
             WHERE (m >> c) & 1 = 1 GROUP BY {RUN}, m),
{name}_f AS (SELECT ID_Analyte, m, sum(CASE WHEN q > 0 AND aa * ll > 0 AND aa * pp > 0 THEN
               pow(least(1.0, r / (n * sqrt(q))), 9.5) * pow(least(1.0, al / sqrt(aa * ll)), 4.5)
               * pow(e / n, 2.5) * pow(least(1.0, ap / sqrt(aa * pp)), 0.5) ELSE 0 END) AS f
             FROM {name}_l JOIN {name}_p USING ({RUN}, m) GROUP BY 1, 2),
{name}_r AS (SELECT ID_Analyte, count(*) AS runs FROM (SELECT DISTINCT {RUN} FROM ce{s}) GROUP BY 1),
{name}_s AS (SELECT ID_Analyte, m, round(coalesce(f, 0) / runs, 9) AS fitness
             FROM {name}_m JOIN {name}_r USING (ID_Analyte) LEFT JOIN {name}_f USING (ID_Analyte, m))"""


def search(name: str, kept: str, s: str = "") -> str:
    """The best of all subsets of the kept fragments. `name`: the chosen fragments; `name_b`: their scores."""
    return _scored(name, kept, s) + f""",
{name}_b AS MATERIALIZED (SELECT ID_Analyte, m, fitness FROM {name}_s
             QUALIFY row_number() OVER (PARTITION BY ID_Analyte ORDER BY fitness DESC, bit_count(m) DESC, m DESC) = 1),
{name} AS MATERIALIZED (SELECT ID_Analyte, {FRAG}, TRUE AS in_set, fitness FROM {name}_c
             JOIN {name}_b USING (ID_Analyte) WHERE (m >> c) & 1 = 1)"""


def climb(name: str, kept: str, s: str = "", previous: str | None = None) -> str:
    """The climb from all starts over the scores of the kept fragments' subsets. `name`: the chosen fragments;
    `name_b`: their scores."""
    was = f"""
             UNION SELECT ID_Analyte, sum(1 << c) FROM {name}_c JOIN {previous} USING (ID_Analyte, {FRAG}) GROUP BY 1""" \
        if previous else ""
    return _scored(name, kept, s) + f""",
{name}_u AS MATERIALIZED (SELECT a.ID_Analyte, a.m, arg_max(b.m, (b.fitness, bit_count(b.m), b.m)) AS better
             FROM {name}_s a JOIN {name}_s b ON a.ID_Analyte = b.ID_Analyte AND bit_count(xor(a.m, b.m)) = 1
             AND b.fitness > a.fitness GROUP BY 1, 2),
{name}_z AS (SELECT DISTINCT ID_Analyte, (1 << kk) - 1 AS m FROM {name}_c
             UNION SELECT ID_Analyte, (1 << kk) - 1 - (1 << c) FROM {name}_c
             UNION SELECT ID_Analyte, sum(1 << c) OVER (PARTITION BY ID_Analyte ORDER BY place) FROM {name}_c{was}),
{name}_w AS (SELECT ID_Analyte, CAST(m AS BIGINT) AS m FROM {name}_z JOIN {name}_s USING (ID_Analyte, m)
             UNION SELECT w.ID_Analyte, better FROM {name}_w w JOIN {name}_u USING (ID_Analyte, m)),
{name}_b AS MATERIALIZED (SELECT ID_Analyte, m, fitness FROM {name}_w ANTI JOIN {name}_u USING (ID_Analyte, m)
             JOIN {name}_s USING (ID_Analyte, m)
             QUALIFY row_number() OVER (PARTITION BY ID_Analyte ORDER BY fitness DESC, bit_count(m) DESC, m DESC) = 1),
{name} AS MATERIALIZED (SELECT ID_Analyte, {FRAG}, TRUE AS in_set, fitness FROM {name}_c
             JOIN {name}_b USING (ID_Analyte) WHERE (m >> c) & 1 = 1)"""


def wide_search(name: str, kept: str) -> str:
    """The same climb for any number of fragments: only the neighbours of subsets on the way are scored."""
    def step(source: str) -> str:
        return f"""
  (WITH nb AS (SELECT ID_Analyte, m, CASE WHEN j < 0 THEN m ELSE xor(m, CAST(1 AS BIGINT) << j) END AS m2, kk FROM {source}
       JOIN (SELECT ID_Analyte, any_value(kk) AS kk FROM {name}_c GROUP BY 1) USING (ID_Analyte), range(-1, 14) AS r(j)
       WHERE j < kk),
     ok AS (SELECT * FROM nb WHERE bit_count(m2) >= least(3, kk)),
     ms AS (SELECT DISTINCT ID_Analyte, m2 FROM ok),
     p AS (SELECT {RUN}, m2, sum(g) AS q, sum(gn) AS r FROM ms JOIN {name}_g USING (ID_Analyte)
       WHERE (m2 >> c) & 1 = 1 AND (m2 >> d) & 1 = 1 GROUP BY {RUN}, m2),
     l AS (SELECT {RUN}, m2, count(*) AS n, sum(e) AS e, sum(aa) AS aa, sum(al) AS al, sum(ll) AS ll, sum(ap) AS ap,
       sum(pp) AS pp FROM ms JOIN {name}_l USING (ID_Analyte) WHERE (m2 >> c) & 1 = 1 GROUP BY {RUN}, m2),
     f AS (SELECT ID_Analyte, m2, sum(CASE WHEN q > 0 AND aa * ll > 0 AND aa * pp > 0 THEN
       pow(least(1.0, r / (n * sqrt(q))), 9.5) * pow(least(1.0, al / sqrt(aa * ll)), 4.5)
       * pow(e / n, 2.5) * pow(least(1.0, ap / sqrt(aa * pp)), 0.5) ELSE 0 END) AS f
       FROM l JOIN p USING ({RUN}, m2) GROUP BY 1, 2),
     s AS (SELECT ID_Analyte, m, m2, round(coalesce(f, 0) / runs, 9) AS fit FROM ok JOIN {name}_r USING (ID_Analyte)
       LEFT JOIN f USING (ID_Analyte, m2)),
     o AS (SELECT ID_Analyte, m, fit AS own FROM s WHERE m = m2)
   SELECT ID_Analyte, m, own, arg_max(m2, (fit, bit_count(m2), m2)) FILTER (fit > own) AS better
   FROM s JOIN o USING (ID_Analyte, m) GROUP BY 1, 2, 3)"""
    return f"""
{name}_c AS MATERIALIZED (SELECT ID_Analyte, {FRAG}, place, row_number() OVER (PARTITION BY ID_Analyte ORDER BY {FRAG} DESC) - 1 AS c,
             count(*) OVER (PARTITION BY ID_Analyte) AS kk FROM {kept}),
{name}_x AS (SELECT x.*, c FROM cx x JOIN {name}_c USING (ID_Analyte, {FRAG})),
{name}_h AS (SELECT a.ID_Analyte, a.ID_Rep, a.IsotopeLabelType, a.c, b.c AS d,
             coalesce(sum(a.x * b.x), 0) AS g FROM {name}_x a JOIN {name}_x b USING ({RUN}, k) GROUP BY ALL),
{name}_g AS MATERIALIZED (SELECT h.*, CASE WHEN own > 0 THEN g / sqrt(own) ELSE 0 END AS gn FROM {name}_h h
             JOIN (SELECT {RUN}, c, g AS own FROM {name}_h WHERE c = d) USING ({RUN}, c)),
{name}_l AS MATERIALIZED (SELECT {RUN}, c, coalesce(err_score, 0) AS e, Area * Area AS aa, coalesce(Area * lib, 0) AS al,
             coalesce(lib * lib, 0) AS ll, Area * mean_area AS ap, mean_area * mean_area AS pp
             FROM ce JOIN {name}_c USING (ID_Analyte, {FRAG}) LEFT JOIN lb USING (ID_Analyte, {FRAG})
             JOIN pr USING (ID_Analyte, IsotopeLabelType, {FRAG})),
{name}_r AS (SELECT ID_Analyte, count(*) AS runs FROM (SELECT DISTINCT {RUN} FROM ce) GROUP BY 1),
{name}_z AS (SELECT ID_Analyte, CAST(m AS BIGINT) AS m FROM (
             SELECT DISTINCT ID_Analyte, kk, (1 << kk) - 1 AS m FROM {name}_c
             UNION SELECT ID_Analyte, kk, (1 << kk) - 1 - (1 << c) FROM {name}_c
             UNION SELECT ID_Analyte, kk, sum(1 << c) OVER (PARTITION BY ID_Analyte ORDER BY place) FROM {name}_c)
             WHERE bit_count(m) >= least(3, kk)),
{name}_w AS ({step(f"{name}_z")}
  UNION {step(f"(SELECT DISTINCT ID_Analyte, better AS m FROM {name}_w WHERE better IS NOT NULL)")}),
{name}_b AS MATERIALIZED (SELECT ID_Analyte, m, own AS fitness FROM {name}_w WHERE better IS NULL
             QUALIFY row_number() OVER (PARTITION BY ID_Analyte ORDER BY own DESC, bit_count(m) DESC, m DESC) = 1),
{name} AS MATERIALIZED (SELECT ID_Analyte, {FRAG}, fitness FROM {name}_c JOIN {name}_b USING (ID_Analyte)
             WHERE (m >> c) & 1 = 1)"""


def subset(name: str, base: str, chosen: str) -> str:
    """Members of a stage: the base, marked by whether they were chosen."""
    return f"""
{name} AS MATERIALIZED (SELECT b.ID_Analyte, b.{FRAG}, c.in_set IS NOT NULL AS in_set
  FROM {base} b LEFT JOIN {chosen} c USING (ID_Analyte, {FRAG}))"""


def scores(name: str, source: str) -> str:
    """Replicate score table from subset rows."""
    key = f"{RUN}, Comment"
    return f"""
{name}_r AS MATERIALIZED (
  SELECT {key},
         round(CASE WHEN count(*) = count(similarity) THEN avg(similarity) END, 9) AS SimilarityScore,
         round(avg(err_score), 9) AS ScoreMassError,
         CASE WHEN sum(Area * Area) * sum(coalesce(lib * lib, 0)) > 0 THEN
           least(1.0, sum(Area * coalesce(lib, 0)) / sqrt(sum(Area * Area) * sum(coalesce(lib * lib, 0)))) END AS Librarydotp
  FROM {source} WHERE in_set GROUP BY ALL),
{name}_i AS (SELECT {key}, sum(CASE WHEN in_set THEN Area ELSE 0 END) / sum(Area) AS IntensityScore
             FROM {source} GROUP BY ALL),
{name}_q AS (SELECT ID_Analyte, Comment, round(quantile_cont(SimilarityScore, 0.75), 9) AS qs,
             round(quantile_cont(ScoreMassError, 0.75), 9) AS qe FROM {name}_r GROUP BY ALL),
{name}_b AS (SELECT {key}, coalesce(SimilarityScore >= qs, FALSE) OR coalesce(ScoreMassError >= qe, FALSE) AS best
             FROM {name}_r JOIN {name}_q USING (ID_Analyte, Comment)),
{name}_p AS (SELECT ID_Analyte, IsotopeLabelType, Comment, {FRAG},
             coalesce(avg(CASE WHEN best THEN Area END), avg(Area)) AS p
             FROM {source} JOIN {name}_b USING ({key}) WHERE in_set GROUP BY ALL),
{name}_m AS (SELECT {key}, CASE WHEN sum(Area * Area) * sum(p * p) > 0 THEN
             least(1.0, sum(Area * p) / sqrt(sum(Area * Area) * sum(p * p))) END AS MPRAScore
             FROM {source} JOIN {name}_p USING (ID_Analyte, IsotopeLabelType, Comment, {FRAG})
             WHERE in_set GROUP BY ALL),
{name} AS MATERIALIZED (
  SELECT {key}, SimilarityScore, MPRAScore, Librarydotp, IntensityScore, ScoreMassError
  FROM {name}_i LEFT JOIN {name}_r USING ({key}) LEFT JOIN {name}_m USING ({key}))"""


SKOR = "pow(SimilarityScore, 9.5) * pow(Librarydotp, 4.5) * pow(ScoreMassError, 2.5) * pow(MPRAScore, 0.5)"


def chain(*parts: str) -> str:
    return ",".join(parts)


# Both passes of the refinement up to the final transitions.
SMALL = f"(SELECT ID_Analyte FROM al GROUP BY 1 HAVING count(*) < 3)"
PASS_1 = chain(
    EXPORT, cells(), everything("al"), rows("ra", "al", "'a-Initial'"),
    f"""
ra3 AS (SELECT * FROM ra WHERE ID_Analyte NOT IN {SMALL})""",
    classified("k1", "ra3"), surviving("kept1", "k1", True))


def passes(first: str, second: str) -> str:
    """Both passes with the given searches `sol1` and `sol2`."""
    return chain(
        PASS_1, first, subset("mc", "kept1", "sol1"), rows("rc", "mc", "'c-After 1st GA optimization'"),
        classified("k2", "rc"), surviving("kept2", "k2", False), second,
        f"""
trans AS MATERIALIZED (SELECT ID_Analyte, {FRAG} FROM sol2
  UNION ALL SELECT ID_Analyte, {FRAG} FROM al WHERE ID_Analyte IN {SMALL})""")


PASS_2 = passes(search("sol1", "kept1"), search("sol2", "kept2"))
CLIMBED = passes(climb("sol1", "kept1"), climb("sol2", "kept2", previous="sol1"))

# Summed traces of the kept transitions and the island around the apex.
BOUNDS = f"""
bg AS (SELECT ID_Analyte, ID_Rep, k, arg_min(t, IsotopeLabelType) AS t, arg_min(z, IsotopeLabelType) = 1 AS z
       FROM zn GROUP BY 1, 2, 3),
bv AS (SELECT ID_Analyte, ID_Rep, k, sum(y) AS v FROM pt JOIN trans USING (ID_Analyte, {FRAG}) GROUP BY 1, 2, 3),
bp AS MATERIALIZED (SELECT * FROM bg JOIN bv USING (ID_Analyte, ID_Rep, k)),
ba AS (SELECT ID_Analyte, ID_Rep, v AS apex, t AS apex_t FROM bp WHERE z
       QUALIFY row_number() OVER (PARTITION BY ID_Analyte, ID_Rep ORDER BY v DESC, t) = 1),
bi AS (SELECT bp.*, apex, apex_t, sum(CASE WHEN v >= apex * CAST(0.05 AS DOUBLE) THEN 0 ELSE 1 END) OVER (
         PARTITION BY ID_Analyte, ID_Rep ORDER BY t) AS island FROM bp JOIN ba USING (ID_Analyte, ID_Rep)),
bj AS (SELECT *, max(CASE WHEN t = apex_t THEN island END) OVER (PARTITION BY ID_Analyte, ID_Rep) AS home FROM bi),
bounds AS MATERIALIZED (SELECT ID_Analyte, ID_Rep, min(t) AS MinStartTime, max(t) AS MaxEndTime FROM bj
  WHERE island = home AND v >= apex * CAST(0.05 AS DOUBLE) GROUP BY 1, 2)"""

def rescored(transitions: str) -> str:
    """The rescoring after both passes."""
    return chain(
        transitions, BOUNDS, f"""
pf AS MATERIALIZED (SELECT p.* REPLACE (b.MinStartTime AS MinStartTime, b.MaxEndTime AS MaxEndTime)
  FROM pt p JOIN trans USING (ID_Analyte, {FRAG}) JOIN bounds b USING (ID_Analyte, ID_Rep))""",
        cells("pf", "f"), everything("alf", "f"), rows("rf", "alf", "'f.GlobalRefinement'", "f"),
        scores("sf", "rf"))


RESCORE = rescored(PASS_2)
CLIMBED_RESCORE = rescored(CLIMBED)
