"""DuckDB SQL building blocks for the oracle of every registered query.

The oracle is written independently of the Spark code: plain SQL over the
pre-registered driver views. Conventions (FIXTURES section 5): doubles rounded
to 6 places, counts as BIGINT, arrays emitted as ``'|'``-joined text, every
column aliased to the Spark name.
"""

from __future__ import annotations

# Total row order of the adapter: copy number, then lineitem columns in order.
ORD = (
    "_copy, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
    "l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
)
ORD_DESC = ", ".join(f"{c.strip()} DESC" for c in ORD.split(","))

BASE = """base AS (
  SELECT l.*, o.o_custkey, p.p_name, p.p_type, p.p_brand, s.s_name
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey)"""


def _raw_select(copy: int, cast_name: str) -> str:
    return f"""SELECT {copy} AS _copy, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
    l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate,
    'u' || CAST(o_custkey AS VARCHAR) AS user_id,
    l_partkey AS movie_id,
    p_name AS movie_title,
    CASE WHEN l_linenumber = 7 AND l_orderkey % 5 = 0 THEN NULL
         ELSE 0.5 * (1.0 + l_quantity % 20) END AS rating,
    CASE WHEN l_partkey % 29 = 0 THEN NULL
         WHEN l_partkey % 31 = 0 THEN ''
         WHEN l_partkey % 5 = 0 THEN p_type || '|' || p_brand
         WHEN l_partkey % 5 = 1 THEN '["' || p_type || '", "Sci-Fi"]'
         WHEN l_partkey % 5 = 2 THEN '[''' || p_type || ''', ''Science_Fiction'']'
         WHEN l_partkey % 5 = 3 THEN '[{{"id": 1, "name": "' || p_type || '"}}]'
         ELSE p_type || ', ' || p_brand || '/Drama' END AS genres,
    CASE WHEN (l_suppkey + l_partkey) % 17 = 0 THEN NULL
         ELSE s_name || ', Supplier#' || CAST(l_suppkey % 7 AS VARCHAR) END AS "{cast_name}",
    CASE WHEN l_partkey % 13 = 0 THEN '1500'
         WHEN l_partkey % 11 = 0 THEN NULL
         WHEN l_partkey % 7 = 0 THEN strftime(l_shipdate, '%Y-%m-%d')
         ELSE CAST(year(l_shipdate) AS VARCHAR) END AS release_year,
    CASE WHEN l_partkey % 10 = 0 THEN 'fr'
         WHEN l_partkey % 10 = 1 THEN ' EN '
         WHEN l_partkey % 23 = 0 THEN NULL
         ELSE 'en' END AS language
  FROM base"""


def raw_ctes() -> list[str]:
    """CTEs ``raw_a`` and ``raw_b`` (the two adapter sources)."""
    a = (
        f"raw_a AS ({_raw_select(0, 'cast')} WHERE l_orderkey % 10 < 6\n"
        f"  UNION ALL {_raw_select(1, 'cast')} WHERE l_orderkey % 10 < 6 AND l_orderkey % 100 = 0)"
    )
    b = f"raw_b AS ({_raw_select(0, 'cast_names')} WHERE l_orderkey % 10 >= 5)"
    return [BASE, a, b]


def canon(x: str) -> str:
    """Canonical genre name in SQL."""
    c = f"trim(regexp_replace(replace(replace(lower(trim({x})), '_', ' '), '-', ' '), '\\s+', ' ', 'g'))"
    return f"(CASE WHEN {c} IN ('sci fi', 'sci fi fantasy') THEN 'science fiction' ELSE {c} END)"


def genre_parse(g: str, variant: str = "clean") -> str:
    """Genre list parse in SQL, by pattern: dict list, quoted list, free text."""
    if variant == "notebook":
        return f"""(CASE WHEN {g} IS NULL OR {g} = '' THEN []::VARCHAR[]
      WHEN contains({g}, '|') THEN list_transform(list_filter(list_transform(string_split({g}, '|'), lambda x: trim(x)), lambda x: x <> ''), lambda x: {canon('x')})
      ELSE list_transform(list_filter(list_transform(regexp_split_to_array({g}, '[,;/]'), lambda x: trim(x)), lambda x: x <> ''), lambda x: {canon('x')}) END)"""
    return f"""(CASE WHEN {g} IS NULL OR {g} = '' THEN []::VARCHAR[]
      WHEN starts_with({g}, '[') AND contains({g}, '{{') THEN list_transform(regexp_extract_all({g}, '"name":\\s*"([^"]*)"', 1), lambda x: {canon('x')})
      WHEN starts_with({g}, '[') THEN list_transform(regexp_extract_all({g}, '["'']([^"'']*)["'']', 1), lambda x: {canon('x')})
      ELSE list_transform(list_filter(list_transform(regexp_split_to_array({g}, '[,|;/]'), lambda x: trim(x)), lambda x: x <> ''), lambda x: {canon('x')}) END)"""


CLEAN_COLUMNS = (
    'user_id, movie_id, movie_title, rating, genres, "cast", release_year, language, '
    "release_year_clean, genres_list, primary_genre, genre_count"
)


def clean_ctes(src: str, out: str, cast_name: str = "cast", profile: str = "full") -> list[str]:
    """P13 in SQL: ``{out}_std`` -> ``{out}_ex`` -> ``{out}_key`` -> ``{out}``."""
    full = profile == "full"
    t = (lambda x: f"trim({x})") if full else (lambda x: x)
    year = (
        "CAST(COALESCE(CASE WHEN TRY_CAST(release_year AS DOUBLE) BETWEEN 1870 AND 2100 "
        "THEN TRY_CAST(release_year AS DOUBLE) END"
        + (", year(TRY_STRPTIME(release_year, '%Y-%m-%d'))" if full else "")
        + ") AS INTEGER)"
    )
    lang = "lower(trim(language))" if full else "language"
    std = f"""{out}_s0 AS (
  SELECT {ORD}, {t('user_id')} AS user_id, movie_id, {t('movie_title')} AS movie_title,
    CASE WHEN isnan(rating) THEN NULL ELSE rating END AS rating, {t('genres')} AS genres,
    {t('"' + cast_name + '"')} AS "cast", {t('release_year')} AS release_year, {lang} AS language
  FROM {src}),
{out}_s1 AS (
  SELECT *, {year} AS release_year_clean,
    {genre_parse('genres', 'clean' if full else 'notebook')} AS genres_list
  FROM {out}_s0),
{out}_std AS (SELECT *, genres_list[1] AS primary_genre, CAST(len(genres_list) AS INTEGER) AS genre_count FROM {out}_s1)"""
    if full:
        ex = f"""{out}_ex AS (
  SELECT * FROM {out}_std
  QUALIFY row_number() OVER (PARTITION BY {CLEAN_COLUMNS} ORDER BY {ORD}) = 1)"""
    else:
        ex = f"{out}_ex AS (SELECT * FROM {out}_std)"
    key = f"""{out}_key AS (
  SELECT * FROM {out}_ex
  QUALIFY row_number() OVER (PARTITION BY user_id, movie_id ORDER BY {ORD_DESC}) = 1)"""
    if full:
        cond = ('user_id IS NOT NULL AND movie_id IS NOT NULL AND rating IS NOT NULL AND genres IS NOT NULL '
                'AND "cast" IS NOT NULL AND len(genres_list) > 0 AND language = \'en\'')
    else:
        cond = "user_id IS NOT NULL AND movie_id IS NOT NULL AND rating IS NOT NULL AND lower(language) = 'en'"
    final = f"{out} AS (SELECT * FROM {out}_key WHERE {cond})"
    return [std, ex, key, final]


def half_step(col: str = "rating") -> str:
    return f"CASE WHEN abs({col} - floor({col}) - 0.5) <= 0.000005010 THEN {col} + 0.5 ELSE {col} END"


def adjusted_cte(src: str, out: str) -> str:
    """P14 applied to a cleaned CTE."""
    return f"{out} AS (SELECT * REPLACE ({half_step()} AS rating) FROM {src})"


def integrated_ctes(out: str = "integ") -> list[str]:
    """U4 over cleaned + adjusted A and B (A first)."""
    return [
        f"""{out}_u AS (
  SELECT 0 AS _part, * , 'TMDB_cleaned' AS source FROM clean_a_adj
  UNION ALL SELECT 1 AS _part, *, 'Trakt_cleaned' AS source FROM clean_b_adj)""",
        f"""{out}_ex AS (
  SELECT * FROM {out}_u
  QUALIFY row_number() OVER (PARTITION BY {CLEAN_COLUMNS}, source ORDER BY _part, {ORD}) = 1)""",
        f"""{out} AS (
  SELECT * FROM {out}_ex
  QUALIFY row_number() OVER (PARTITION BY user_id, movie_id, rating ORDER BY _part, {ORD}) = 1)""",
    ]


def pipeline_ctes(through: str = "clean") -> list[str]:
    """Standard CTE chain: raw -> clean (A, B) -> adjusted -> integrated."""
    ctes = raw_ctes()
    ctes += clean_ctes("raw_a", "clean_a", "cast")
    ctes += clean_ctes("raw_b", "clean_b", "cast_names")
    if through in ("adjusted", "integrated"):
        ctes += [adjusted_cte("clean_a", "clean_a_adj"), adjusted_cte("clean_b", "clean_b_adj")]
    if through == "integrated":
        ctes += integrated_ctes()
    return ctes


def with_query(ctes: list[str], select: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(ctes) + "\n" + select


def r6(expr: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 6)"


def joined(expr: str) -> str:
    return f"array_to_string({expr}, '|')"


def transform_ctes() -> list[str]:
    """A12 + F3 + P18 over ``integ`` -> ``trans``."""
    def mode(key: str, col: str, name: str) -> str:
        return f"""{name} AS (
  SELECT {key}, v FROM (SELECT {key}, {col} AS v, count(*) AS n FROM t_don WHERE {col} IS NOT NULL GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY n DESC, v) = 1)"""
    return [
        """t_don AS (
  SELECT movie_id, movie_title,
    CASE WHEN trim("cast") <> '' THEN trim("cast") END AS c,
    CASE WHEN trim(genres) <> '' THEN trim(genres) END AS g
  FROM integ)""",
        mode("movie_id", "c", "m_id_c"), mode("movie_id", "g", "m_id_g"),
        mode("movie_title", "c", "m_ti_c"), mode("movie_title", "g", "m_ti_g"),
        """t_imp AS (
  SELECT i.* REPLACE (
    coalesce(CASE WHEN trim(i."cast") <> '' THEN i."cast" END, a.v, c.v, 'unknown') AS "cast",
    coalesce(CASE WHEN trim(i.genres) <> '' THEN i.genres END, b.v, d.v, 'unknown') AS genres)
  FROM integ i
  LEFT JOIN m_id_c a ON i.movie_id = a.movie_id
  LEFT JOIN m_id_g b ON i.movie_id = b.movie_id
  LEFT JOIN m_ti_c c ON i.movie_title = c.movie_title
  LEFT JOIN m_ti_g d ON i.movie_title = d.movie_title)""",
        f"""t_gen AS (
  SELECT * REPLACE ({genre_parse('genres')} AS genres_list) FROM t_imp)""",
        """trans AS (
  SELECT * EXCLUDE (genres, release_year_clean) REPLACE (
    coalesce(genres_list[1], 'unknown') AS primary_genre,
    CAST(len(genres_list) AS INTEGER) AS genre_count,
    coalesce(TRY_CAST(release_year AS DOUBLE), CAST(release_year_clean AS DOUBLE)) AS release_year)
  FROM t_gen)""",
    ]


def encode_ctes() -> list[str]:
    """E7 (non-wide part) over ``trans`` -> ``enc``."""
    def mm(x: str) -> str:
        return (f"CASE WHEN max({x}) OVER () = min({x}) OVER () THEN {x} - min({x}) OVER () "
                f"ELSE ({x} - min({x}) OVER ()) / (max({x}) OVER () - min({x}) OVER ()) END")
    return [
        """e0 AS (
  SELECT * REPLACE (coalesce("cast", 'unknown') AS "cast"),
    coalesce(release_year, 0.0) AS _y, coalesce(CAST(genre_count AS DOUBLE), 0.0) AS _gc
  FROM trans)""",
        f"""enc AS (
  SELECT * EXCLUDE (_y, _gc),
    dense_rank() OVER (ORDER BY coalesce(primary_genre, 'unknown')) - 1 AS primary_genre_encoded,
    dense_rank() OVER (ORDER BY user_id) - 1 AS user_idx,
    dense_rank() OVER (ORDER BY CAST(movie_id AS VARCHAR)) - 1 AS movie_idx,
    CASE source WHEN 'TMDB_cleaned' THEN 0 WHEN 'Trakt_cleaned' THEN 1 END AS source_encoded,
    {mm('rating')} AS rating_scaled,
    {mm('_y')} AS year_scaled,
    {mm('_gc')} AS genre_count_scaled
  FROM e0)""",
    ]


def split_ctes(seed: int = 42) -> list[str]:
    """W8 over ``enc`` by ``user_idx`` -> ``assign`` (user_idx, split), ``splitted``."""
    return [
        f"""u_rank AS (
  SELECT user_idx, row_number() OVER (ORDER BY md5('{seed}:' || CAST(user_idx AS VARCHAR)), user_idx) - 1 AS r,
         count(*) OVER () AS u
  FROM (SELECT DISTINCT user_idx FROM enc))""",
        """assign AS (
  SELECT user_idx, CASE WHEN r < floor(0.7 * u) THEN 'train'
                        WHEN r < floor(0.7 * u) + floor(0.5 * (u - floor(0.7 * u))) THEN 'val'
                        ELSE 'test' END AS split
  FROM u_rank)""",
        "splitted AS (SELECT e.*, a.split FROM enc e JOIN assign a USING (user_idx))",
    ]


def stage_ctes(through: str) -> list[str]:
    ctes = pipeline_ctes("integrated")
    order = ["transformed", "encoded", "split"]
    builders = [transform_ctes, encode_ctes, split_ctes]
    for name, build in zip(order, builders):
        ctes += build()
        if name == through:
            break
    return ctes
