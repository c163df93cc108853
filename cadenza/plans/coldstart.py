"""Cold-start plan: catalogue features -> aligned factors -> one-hot, impute, assemble ->
nested hold-out -> ridge alpha search -> coefficients -> scoring of held-out items (SURVEY §3.3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.operators import coldstart as CS
from cadenza.operators import features as FE
from cadenza.operators import interactions as I
from cadenza.operators import ridge as RG
from cadenza.session import reliable_checkpoint
from cadenza.sources import tables as TB
from cadenza.sources.tables import Tables, played_tracks, plays

NUMERIC = ["duration", "loudness", "tempo"]
CATEGORICAL = ["release", "artist_id"]
SHIPPED_KEYS = 1 << 20  # track keys (8 bytes each) that are shipped to the lines; more are joined by a shuffle


def aligned_items(t: Tables) -> DataFrame:
    """C2 without expanding the factors: ``mapped_id, artist_id, release, duration, loudness, tempo, y``.

    The tracks that have factors are found first: the averages over lines and the catalogue joins are made for them only.
    """
    idmap = I.build_id_index(played_tracks(t.orders, t.lineitem), "track_id", "mapped_id")
    fac = TB.item_factors(t.embeddings).select(F.col("id").alias("mapped_id"),
                                               F.col("features").cast("array<double>").alias("y"))
    used = idmap.join(fac.select("mapped_id"), "mapped_id", "left_semi").transform(reliable_checkpoint)
    keys = used.select(F.col("track_id").cast("long").alias("_k"))
    keys = F.broadcast(keys) if used.count() <= SHIPPED_KEYS else keys
    extras = FE.clean_extras(TB.acoustic_extras(t.lineitem.join(keys, F.col("l_partkey") == F.col("_k"), "left_semi")))
    tracks = TB.catalog(t.part.join(keys, F.col("p_partkey") == F.col("_k"), "left_semi"))
    c1 = FE.catalogue_features(tracks, TB.artist_term(t.part), TB.artist_location(t.nation, t.region), extras)
    feats = c1.select("track_id", "artist_id", "release", "duration", "loudness", "tempo")
    return used.join(feats, "track_id").drop("track_id").join(fac, "mapped_id")


def design_matrix(items: DataFrame):
    """C3 + C4 + C5: ``(mapped_id, idx, val, y)`` and the feature count."""
    enc, sizes = CS.one_hot(items, CATEGORICAL)
    imp = CS.impute_mean(enc, NUMERIC)
    out, d = CS.assemble(imp, CATEGORICAL, sizes, NUMERIC)
    return out.select("mapped_id", "idx", "val", "y"), d


def fit(spark, t: Tables, alphas=(0.0, 0.001, 0.005, 0.01, 0.05, 0.1, 0.5, 1.0)):
    """C6 + C7 on the R4 split; returns the alpha-search result and the design table with its split."""
    x, d = design_matrix(aligned_items(t).transform(reliable_checkpoint))
    train, val, test = I.nested_holdout(x, F.col("mapped_id"))
    x = (train.withColumn("split", F.lit("train")).unionByName(val.withColumn("split", F.lit("validation")))
         .unionByName(test.withColumn("split", F.lit("test")))).transform(reliable_checkpoint)
    r = len(x.select("y").first()[0])
    res = RG.alpha_search(RG.Moments(x, d, r, "split"), "train", "validation", "test", alphas)
    res["d"], res["r"] = d, r
    return res, x


def alpha_table(spark, res) -> DataFrame:
    rows = [(float(s["alpha"]), s["val_mse"], s["val_r2"], float(s["alpha"]) == float(res["best_alpha"]))
            for s in res["scores"]]
    return spark.createDataFrame(rows, "alpha double, val_mse double, val_r2 double, best boolean")


def _predicted(fitted):
    res, x = fitted
    test = x.where("split = 'test'")
    pred = RG.predict(test.select("mapped_id", "idx", "val"), res["refit"](), res["best_alpha"], "mapped_id").select(
        F.col("mapped_id").alias("id"), F.col("pred").alias("features")).transform(reliable_checkpoint)
    return pred, test.select(F.col("mapped_id").alias("id"), F.col("y").alias("features"))


def cold_start_recall(spark, t: Tables, k: int = 10, fitted=None) -> DataFrame:
    """Held-out items get factors predicted from their features; their exact top-k neighbours
    among all items are compared with those of their true factors (recall@k)."""
    from cadenza.operators.ann import recall_at_k
    from cadenza.operators.retrieve import exact_top_k
    pred, true = _predicted(fitted or fit(spark, t))
    items = TB.item_factors(t.embeddings).select("id", "features")
    return recall_at_k(exact_top_k(pred, items, k, metric="cosine"), exact_top_k(true, items, k, metric="cosine"), k)


def _scored(t: Tables, named_items, k: int, ks) -> DataFrame:
    """Per named factor table of held-out items: the users' lists of those items against the plays of them."""
    from cadenza.operators import metrics as M
    from cadenza.operators.retrieve import exact_top_k_lists
    idmap = I.build_id_index(played_tracks(t.orders, t.lineitem), "track_id", "mapped_id")
    held = named_items[0][1].select(F.col("id").alias("mapped_id"))
    pairs = (plays(t.orders, t.lineitem).join(idmap, "track_id").join(held, "mapped_id")
             .select(F.col("user_id").cast("int").alias("user"), F.col("mapped_id").alias("item"))).transform(reliable_checkpoint)
    users = TB.item_factors(t.embeddings).select("id", "features").join(pairs.select(F.col("user").alias("id")).distinct(), "id")
    out = []
    for name, items in named_items:
        lists = exact_top_k_lists(users, items, k, metric="dot").select(
            F.col("qid").cast("int").alias("user"), F.col("items").cast("array<int>").alias("items")).transform(reliable_checkpoint)
        m = M.evaluate_distinct_lists(lists, pairs, "user", "item", "items", ks, decimals=6)
        out.append(m.select(F.lit(name).alias("factors"), "*"))
    return I.union_all(out)


def cold_start_eval(spark, t: Tables, k: int = 500, ks=(10, 20, 50, 100, 500), fitted=None) -> DataFrame:
    """C9 + J7 + A7-A9: users rank the held-out items by predicted factors; their lists are scored against the
    plays of those items. The true factors are the other row, as the ceiling."""
    pred, true = _predicted(fitted or fit(spark, t))
    return _scored(t, [("predicted", pred), ("true", true)], k, ks)


def true_factor_eval(t: Tables, k: int = 500, ks=(10, 20, 50, 100, 500)) -> DataFrame:
    """The ceiling row of :func:`cold_start_eval` alone: the same held-out items and plays, without a fit."""
    _, _, test = I.nested_holdout(aligned_items(t), F.col("mapped_id"))
    held = test.select(F.col("mapped_id").alias("id"), F.col("y").alias("features")).transform(reliable_checkpoint)
    return _scored(t, [("true", held)], k, ks)
