"""DuckDB building blocks for the oracle SQL: the stand-in views as CTE text.

These are written independently of the Spark code (window functions, plain
joins) so the oracle is a second formulation, not a transcript.
"""

from __future__ import annotations


def bucket(key: str, n: int = 10) -> str:
    return f"CAST((('0x' || substr(md5({key}), 1, 8))::UBIGINT % {n}) AS INTEGER)"


PLAYS = """WITH plays AS (
  SELECT CAST(o.o_custkey AS VARCHAR) AS user_id, CAST(l.l_partkey AS VARCHAR) AS track_id,
         CAST(count(*) AS INTEGER) AS "count"
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  GROUP BY o.o_custkey, l.l_partkey)"""

INDEXED = PLAYS + f""",
uidx AS (SELECT user_id, CAST(dense_rank() OVER (ORDER BY user_id) - 1 AS INTEGER) AS user_id_index
         FROM (SELECT DISTINCT user_id FROM plays)),
iidx AS (SELECT track_id, CAST(dense_rank() OVER (ORDER BY track_id) - 1 AS INTEGER) AS track_id_index
         FROM (SELECT DISTINCT track_id FROM plays)),
ip AS (SELECT u.user_id_index, p."count", i.track_id_index, p.user_id, p.track_id,
              {bucket("p.user_id || '|' || p.track_id")} AS b
       FROM plays p JOIN uidx u ON p.user_id = u.user_id JOIN iidx i ON p.track_id = i.track_id),
train AS (SELECT * FROM ip WHERE b < 8),
val AS (SELECT * FROM ip WHERE b >= 8)"""


def metrics_from_preds(preds_cte: str, ks=(10,)) -> str:
    """Average MAP / P@k / NDCG@k given CTEs ``preds(user_id_index, pos, track_id_index)``,
    ``tgt(user_id_index, track_id_index)`` (distinct) and ``pusers(user_id_index)``."""
    pk = ",\n".join(
        f"sum(CASE WHEN pos < {k} THEN hit ELSE 0 END) / {float(k)} AS p_at_{k},"
        f" sum(CASE WHEN pos < {k} THEN hit / ln(pos + 2.0) ELSE 0 END) AS dcg_{k}" for k in ks)
    idcg = ",\n".join(
        f"list_sum(list_transform(range(least(n_rel, {k})), lambda i: 1.0 / ln(i + 2.0))) AS idcg_{k}" for k in ks)
    outs = ",\n".join(f"round_even(avg(p_at_{k}), 6) AS p_at_{k}, round_even(avg(coalesce(dcg_{k}, 0) / idcg_{k}), 6) AS ndcg_at_{k}"
                      for k in ks)
    return f"""{preds_cte},
nrel AS (SELECT user_id_index, count(*) AS n_rel FROM tgt GROUP BY user_id_index),
ev AS (SELECT n.user_id_index, n.n_rel FROM nrel n WHERE n.user_id_index IN (SELECT user_id_index FROM pusers)),
h AS (SELECT p.user_id_index, p.pos, CASE WHEN t.track_id_index IS NULL THEN 0 ELSE 1 END AS hit
      FROM preds p LEFT JOIN tgt t ON p.user_id_index = t.user_id_index AND p.track_id_index = t.track_id_index),
c AS (SELECT *, sum(hit) OVER (PARTITION BY user_id_index ORDER BY pos ROWS UNBOUNDED PRECEDING) AS cum FROM h),
pu AS (SELECT user_id_index, sum(hit * cum / (pos + 1.0)) AS ap_num, {pk} FROM c GROUP BY user_id_index),
sc AS (SELECT ev.user_id_index, ev.n_rel, coalesce(pu.ap_num, 0) / ev.n_rel AS ap,
              {", ".join(f"coalesce(pu.p_at_{k}, 0) AS p_at_{k}, pu.dcg_{k}" for k in ks)}, {idcg}
       FROM ev LEFT JOIN pu ON ev.user_id_index = pu.user_id_index)
SELECT count(*) AS n_users, round_even(avg(ap), 6) AS map, {outs} FROM sc"""


CATALOG = """catalog AS (SELECT CAST(p_partkey AS VARCHAR) AS track_id, p_name AS title, p_brand AS artist_id,
    p_type AS release, CAST(p_size AS DOUBLE) AS duration FROM part)"""
ARTIST_TERM = """artist_term AS (SELECT p_brand AS artist_id, p_partkey AS pos,
    CASE WHEN p_partkey % 3 = 0 THEN w ELSE w || ' ' || lower(p_type) END AS term
  FROM (SELECT *, ['pop rock', 'hip hop', 'classic rock', 'pop', 'country', 'soul', 'jazz', 'blues', 'electro', 'heavy metal', 'folk',
    'raggae', 'trip hop', 'rap', 'reggae', 'disco', 'house', 'dance', 'ccm', 'ambient', 'new wave', 'spoken word'][p_partkey % 22 + 1] AS w FROM part))"""
ARTIST_LOCATION = """artist_location AS (SELECT 'Brand#' || CAST(n_nationkey AS VARCHAR) AS artist_id,
    CAST(n_nationkey AS DOUBLE) AS latitude, CAST(n_regionkey AS DOUBLE) AS longitude, n_name AS artist_name,
    r_name AS location FROM nation LEFT JOIN region ON n_regionkey = r_regionkey)"""
EXTRAS = """extras_raw AS (SELECT 'b' || chr(39) || CAST(l_partkey AS VARCHAR) || chr(39) AS track_id,
    round(sum(l_extendedprice), 2) / count(l_extendedprice) AS loudness,
    round(sum(l_discount), 2) / count(l_discount) AS song_hotttnesss, avg(l_quantity) AS tempo
    FROM lineitem GROUP BY l_partkey),
extras AS (SELECT split_part(track_id, chr(39), 2) AS track_id, loudness, song_hotttnesss, tempo FROM extras_raw)"""
TERMS = """terms AS (SELECT artist_id, list(term ORDER BY pos, term) AS term FROM artist_term GROUP BY artist_id)"""
RELEASES = """releases AS (SELECT CAST(l_partkey AS VARCHAR) AS track_id,
    CASE WHEN l_linestatus = 'O' THEN '0000-00-00' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS releasedate
    FROM lineitem)"""
C1 = CATALOG + ",\n" + ARTIST_TERM + ",\n" + ARTIST_LOCATION + ",\n" + EXTRAS + ",\n" + TERMS + """,
artists AS (SELECT coalesce(t.artist_id, l.artist_id) AS artist_id, t.term, l.latitude, l.longitude, l.location
            FROM terms t FULL OUTER JOIN artist_location l ON t.artist_id = l.artist_id),
c1 AS (SELECT c.*, a.term, a.latitude, a.longitude, a.location, e.loudness, e.song_hotttnesss, e.tempo
       FROM catalog c LEFT JOIN artists a ON c.artist_id = a.artist_id LEFT JOIN extras e ON c.track_id = e.track_id)"""


def genre_case(term: str):
    """(recoded, labelled) CASE expressions, written out here and not taken from the implementation."""
    # The genre rules, first match wins, and the genres that are kept.
    recoded = f"""(CASE WHEN contains({term}, 'pop rock') THEN 'pop rock' WHEN contains({term}, 'hip hop') THEN 'hip hop'
 WHEN contains({term}, 'rock') THEN 'rock' WHEN contains({term}, 'pop') THEN 'pop music' WHEN contains({term}, 'country') THEN 'country music'
 WHEN contains({term}, 'soul') THEN 'soul' WHEN contains({term}, 'jazz') THEN 'jazz' WHEN contains({term}, 'blues') THEN 'blues'
 WHEN contains({term}, 'electr') THEN 'electronic' WHEN contains({term}, 'metal') THEN 'metal' WHEN contains({term}, 'folk') THEN 'folk'
 WHEN contains({term}, 'raggae') THEN 'raggae' WHEN contains({term}, 'hop') THEN 'hip hop' WHEN contains({term}, 'rap') THEN 'rap'
 WHEN contains({term}, 'reggae') THEN 'raggae' WHEN contains({term}, 'disco') THEN 'disco' WHEN contains({term}, 'house') THEN 'house'
 WHEN contains({term}, 'dance') THEN 'dance' ELSE {term} END)"""
    kept = """'rock', 'pop music', 'metal', 'jazz', 'hip hop', 'pop rock', 'house', 'soul', 'rap', 'dance', 'raggae', 'ccm', 'post-grunge',
 'disco', 'electronic', 'ballad', 'country music', 'blues', 'folk', 'chill-out', 'new wave', 'chanson'"""
    return recoded, f"(CASE WHEN {recoded} IN ({kept}) THEN {recoded} ELSE 'other' END)"


MUSICDB = """mb_artist AS (SELECT s_suppkey AS id, 'gid-' || CAST(s_suppkey AS VARCHAR) AS gid, s_name AS name FROM supplier),
mb_track AS (SELECT CAST(l_orderkey * 8 + l_linenumber AS BIGINT) AS id, p_name AS name, l_suppkey AS artist
             FROM lineitem JOIN part ON l_partkey = p_partkey),
mb_albumjoin AS (SELECT CAST(l_orderkey * 8 + l_linenumber AS BIGINT) AS track, l_orderkey AS album FROM lineitem),
mb_album AS (SELECT o_orderkey AS id, o_orderpriority AS name, a.artist
             FROM orders JOIN (SELECT l_orderkey, min(l_suppkey) AS artist FROM lineitem GROUP BY l_orderkey) a
             ON o_orderkey = a.l_orderkey),
mb_release AS (SELECT o_orderkey AS album, CASE WHEN o_orderstatus = 'P' THEN '0000-00-00'
               ELSE strftime(o_orderdate, '%Y-%m-%d') END AS releasedate FROM orders),
songs AS (SELECT p.p_partkey AS song_id,
     CASE WHEN sp.sup IS NULL THEN ''
          WHEN p.p_size >= 40 THEN 'gid-' || CAST(sp.sup + 1 AS VARCHAR)
          WHEN p.p_size >= 20 THEN 'gid-' || CAST(sp.sup AS VARCHAR)
          WHEN p.p_size >= 10 THEN 'gid-unknown-' || CAST(sp.sup AS VARCHAR) ELSE '' END AS artist_gid,
     upper(s.s_name) AS artist_name, upper(p.p_name) AS title,
     CASE WHEN p.p_size % 2 = 0 THEN '1-urgent' ELSE lower(p.p_type) END AS "release"
   FROM part p LEFT JOIN (SELECT l_partkey, min(l_suppkey) AS sup FROM lineitem GROUP BY l_partkey) sp
     ON p.p_partkey = sp.l_partkey LEFT JOIN supplier s ON sp.sup = s.s_suppkey)"""
