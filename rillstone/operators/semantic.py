"""Text profiles: TF-IDF as relations, principal components and clusters."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from rillstone.operators.vectors import with_clusters, with_pca
from rillstone.storage import materialize, spread

#: What parts words: all but letters and digits of any script and the underscore.
TOKEN = r"[^\p{L}\p{N}_]+"


def _commonest(pairs: DataFrame, most: int) -> DataFrame:
    """``term, total, df`` of the ``most`` commonest terms of rows ``term, tf``, ties by term. Each task adds up its own
    rows first, so a term is shuffled once for each task that meets it."""
    return pairs.groupBy("term").agg(F.sum("tf").alias("total"), F.count("*").alias("df")).orderBy(F.desc("total"), "term").limit(most)


#: What ``common_terms`` takes as its third argument by default.
TRACKED = 100_000


def common_terms(counts: DataFrame, most: int, tracked: int = TRACKED) -> DataFrame:
    """``term, total, df`` of the ``most`` commonest terms of ``counts`` (c: array of term, tf), ties by term.

    All terms are counted. ``tracked``, once the size of a sketch, changes nothing: sketches of so many items took longer
    than the counts.
    """
    return _commonest(counts.select(F.explode("c").alias("c")).select("c.term", "c.tf"), most)


#: Texts whose words are looked up at once.
TEXTS = 256


def _looked_up(terms: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Task function: (key, words) to (key, c: places in ``terms`` of the words that stand there, with their counts)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, size = pa.array(terms, pa.string()), max(len(terms), 1)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                some = batch.slice(at, TEXTS)
                words = some.column(1)
                place = pc.index_in(words.flatten().cast(pa.string()), known)
                row = np.repeat(np.arange(len(words)), pc.list_value_length(words).to_numpy())
                found = place.is_valid().to_numpy(zero_copy_only=False)
                pairs, tf = np.unique(row[found] * size + place.drop_null().to_numpy(), return_counts=True)
                starts = np.searchsorted(pairs, np.arange(len(words) + 1) * size).astype(np.int32)
                counted = pa.StructArray.from_arrays([pa.array(pairs % size, pa.int32()), pa.array(tf, pa.int32())], ["place", "tf"])
                yield pa.RecordBatch.from_arrays([some.column(0), pa.ListArray.from_arrays(starts, counted)], [some.schema.names[0], "c"])

    return count


def tfidf(df: DataFrame, key: str, text: str, max_features: int = 2000) -> DataFrame:
    """``key, term, weight``: smooth inverse document frequency ln((1 + n) / (1 + df)) + 1, rows of length 1.

    Terms are words of two letters or more in lower case; the ``max_features`` commonest (ties by term) count. Rows of
    one key are one text. Texts are read twice: for the vocabulary, whose counts are all that is shuffled, and for the
    counts of its terms, which are written, one row a text. Only tables of the vocabulary's size, which ``max_features``
    bounds, reach the driver.
    """
    texts = spread(df.select(key, F.coalesce(F.col(text), F.lit("")).alias("__text")))
    repeated = df.groupBy(key).count().where("count > 1").select(key)
    if not repeated.isEmpty():
        again = repeated.select(F.col(key).alias("__again"))
        same = F.col(key).eqNullSafe(F.col("__again"))
        texts = texts.join(again, same, "left_anti").unionByName(texts.join(again, same, "left_semi").groupBy(key).agg(F.concat_ws(" ", F.collect_list("__text")).alias("__text")))
    words = texts.select(key, F.split(F.lower("__text"), TOKEN).alias("__words"))
    said = words.select(F.explode("__words").alias("term")).where(F.length("term") > 1)
    terms = [r.term for r in _commonest(said.withColumn("tf", F.lit(1)), max_features).collect()]
    schema = StructType([texts.schema[key], StructField("c", ArrayType(StructType([StructField("place", IntegerType()), StructField("tf", IntegerType())])))])
    counted = materialize(words.mapInArrow(_looked_up(terms), schema), "term-counts")
    n = counted.count()
    idf = [0.0] * len(terms)
    for r in counted.select(F.explode("c.place").alias("place")).groupBy("place").count().collect():  # max_features at most
        idf[r.place] = math.log((1.0 + n) / (1.0 + r["count"])) + 1
    known = df.sparkSession.createDataFrame(pa.table({"__terms": pa.array([terms], pa.list_(pa.string())), "__idf": [idf]}))
    raw = counted.where(F.size("c") > 0).crossJoin(F.broadcast(known)).withColumn("__w", F.transform("c", lambda x: x["tf"] * F.get("__idf", x["place"])))
    normed = raw.withColumn("__norm", F.sqrt(F.aggregate("__w", F.lit(0.0), lambda a, w: a + w * w)))
    each = normed.select(key, "__terms", "__norm", F.explode(F.arrays_zip(F.col("c.place").alias("place"), F.col("__w").alias("w"))).alias("x"))
    return each.select(key, F.get("__terms", F.col("x.place")).alias("term"), (F.col("x.w") / F.col("__norm")).alias("weight"))


def _sparse_rows(df: DataFrame, key: str, text: str, max_features: int = 2000) -> DataFrame:
    """``df`` with TF-IDF rows as sparse vectors, places being the terms' numbers in their order; without terms, empty ones.

    Components and clusters pass over the rows again and again, so they are written.
    """
    weights = tfidf(df, key, text, max_features)
    names = weights.select("term").distinct().agg(F.sort_array(F.collect_list("term")).alias("t"))  # max_features at most
    places = names.select(F.posexplode("t").alias("place", "term"))
    numbered = weights.join(F.broadcast(places), "term").select(F.col(key).alias("__key"), F.struct("place", "weight").alias("x"))
    vectors = numbered.groupBy("__key").agg(F.array_sort(F.collect_list("x")).alias("x")).select("__key", F.struct(F.col("x.place").alias("i"), F.col("x.weight").alias("w")).alias("__v"))
    none = F.struct(F.array().cast("array<int>").alias("i"), F.array().cast("array<double>").alias("w"))
    return materialize(df.join(vectors, F.col(key).eqNullSafe(F.col("__key")), "left").withColumn("embedding", F.coalesce("__v", none)).drop("__key", "__v"), "sparse-rows")


#: Ways to embed a text column; ``register_transformer`` adds models.
EMBEDDINGS: dict[str, Callable[[DataFrame, str, str], DataFrame]] = {"tfidf": _sparse_rows}


def _open_onnx(model: str):
    import onnxruntime

    return onnxruntime.InferenceSession(model, providers=["CPUExecutionProvider"])


def _open_tokenizer(vocabulary: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary)


def register_transformer(name: str, model: str, vocabulary: str, prefix: str = "", batch: int = 64, most: int = 512, open_model: Callable = _open_onnx, open_vocabulary: Callable = _open_tokenizer) -> None:
    """Add the embedding ``name``: a transformer in ONNX form with its tokenizer file, which all executors can open.

    A text is the mean of its tokens' last states, of length 1; ``prefix`` stands before each text (a task, say), and the
    model reads the first ``most`` tokens, its own bound. Blank texts give zeros. Sessions live as long as their workers.
    """

    def embed(df: DataFrame, key: str, text: str) -> DataFrame:
        opened: list = []

        @F.pandas_udf("array<double>")
        def vectors(texts: pd.Series) -> pd.Series:
            if not opened:
                opened.extend((open_model(model), open_vocabulary(vocabulary)))
            session, tokenizer = opened
            wanted = [i.name for i in session.get_inputs()]
            out: list[np.ndarray] = []
            for at in range(0, len(texts), batch):
                ids = [tokenizer.encode(prefix + t).ids[:most] for t in texts.iloc[at : at + batch]]
                mask = np.zeros((len(ids), max(map(len, ids), default=0) or 1), np.int64)
                padded = mask.copy()
                for k, row in enumerate(ids):
                    mask[k, : len(row)], padded[k, : len(row)] = 1, row
                given = {"input_ids": padded, "attention_mask": mask, "token_type_ids": np.zeros_like(mask)}
                states = session.run(None, {n: given[n] for n in wanted})[0]
                blank = np.array([not t.strip() for t in texts.iloc[at : at + batch]])
                mean = (states * mask[:, :, None]).sum(1) / np.maximum(mask.sum(1), 1)[:, None] * ~blank[:, None]
                out.extend(mean / np.maximum(np.linalg.norm(mean, axis=1), 1e-12)[:, None])
            return pd.Series([v.astype(float).tolist() for v in out])

        return df.withColumn("embedding", vectors(F.coalesce(F.col(text), F.lit(""))))

    EMBEDDINGS[name] = embed


def analyze(df: DataFrame, key: str, text: str, method: str = "tfidf", components: int = 3, clusters: int = 8) -> tuple[DataFrame, dict]:
    """``df`` with components and cluster labels of the whole vectors, and what was done. Raises if no text has words."""
    if method not in EMBEDDINGS:
        raise ValueError(f"unknown embedding {method!r}; known: {', '.join(sorted(EMBEDDINGS))}")
    if df.where(F.trim(F.coalesce(F.col(text), F.lit(""))) != "").isEmpty():
        raise ValueError("all texts are blank")
    placed, shares = with_pca(EMBEDDINGS[method](df, key, text), "embedding", components)
    labelled = with_clusters(placed, "embedding", clusters).drop("embedding")
    return labelled, {"method": method, "components": components, "clusters": clusters, "explained_variance": shares}
