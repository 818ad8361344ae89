"""Feature engineering (M1-M8).

``build_features`` is the one feature builder for training *and* scoring, so
a request is featurized exactly like a training row.  Source columns are given
by ``Roles`` so the same code runs on trending-video records and on any table
bound to them.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (IDF, CountVectorizer, HashingTF, OneHotEncoder,
                                StringIndexer, VectorAssembler, VectorSlicer)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (as_string, drop_blank, lower_all, ratio, split_on, text_length,
                                 time_part, word_count_single_space, word_count_whitespace)
from ..operators.clean import as_categorical
from .vectors import vector_entries


@dataclass(frozen=True)
class Roles:
    """Which source column plays which part of a trending-video record."""
    title: str = "title"
    tags: str = "tags"
    tags_sep: str = r"\|"
    category: str = "categoryId"
    published: str = "publishedAt"
    channel: str = "channelTitle"
    views: str = "view_count"
    likes: str = "likes"
    dislikes: str = "dislikes"
    comments: str = "comment_count"


VIDEO_ROLES = Roles()

# The categorical inputs of the model jobs (6 numeric-as-string + channel).
CATEGORICAL = ["categoryID_str", "title_length_str", "word_count_str", "publish_month_str",
               "publish_dayofweek_str", "publish_hour_str", "channel_lower"]
EDA_CATEGORICAL = CATEGORICAL[:6]
TARGETS = ["comments_ratio", "likes_ratio", "view_count", "likes", "dislikes", "comment_count"]


def build_features(df: DataFrame, roles: Roles = VIDEO_ROLES,
                   drop_blank_tags: bool = False, whitespace_words: bool = False) -> DataFrame:
    """M1: every derived column in one projection.

    Targets missing from ``df`` (a scoring request) are skipped.
    ``drop_blank_tags`` removes blank tags (P8) and ``whitespace_words`` counts
    words between any white space (F3); training and scoring must use the same
    values (``train_job`` and ``score`` take them as ``builder``).
    """
    cols = set(df.columns)
    pub = F.col(roles.published)
    tag_array = split_on(roles.tags, roles.tags_sep)
    lowered = lower_all(tag_array)
    if drop_blank_tags:
        lowered = drop_blank(lowered)
    new = {
        "title_length": text_length(roles.title),
        "word_count": (word_count_whitespace if whitespace_words else word_count_single_space)(roles.title),
        "publish_year": time_part(pub, "year"),
        "publish_month": time_part(pub, "month"),
        "publish_dayofweek": time_part(pub, "dayofweek"),
        "publish_hour": time_part(pub, "hour"),
        "tag_array": tag_array,
        "tag_array_lower": lowered,
        "channel_lower": F.lower(F.col(roles.channel)),
        "categoryID_str": as_string(roles.category),
    }
    counts = {"view_count": roles.views, "likes": roles.likes,
              "dislikes": roles.dislikes, "comment_count": roles.comments}
    have = {k: v for k, v in counts.items() if v in cols}
    for k, v in have.items():
        new[k] = F.col(v).cast("double")
    if {"view_count", "likes"} <= have.keys():
        new["likes_ratio"] = ratio(roles.likes, roles.views, 2)
    if {"view_count", "dislikes"} <= have.keys():
        new["dislikes_ratio"] = ratio(roles.dislikes, roles.views, 10)
    if {"view_count", "comment_count"} <= have.keys():
        new["comments_ratio"] = ratio(roles.comments, roles.views)
    return as_categorical(df.withColumns(new), ["title_length", "word_count", "publish_month",
                                                "publish_dayofweek", "publish_hour"])


@dataclass(frozen=True)
class FeatureSpec:
    """How tags and categoricals become one vector."""
    text: str | None = "hashing"     # hashing | count | tfidf | None (categoricals only)
    num_features: int = 262144       # hashing width
    vocab_size: int | None = None    # count / tfidf: None keeps every term of min_df documents
    min_df: float = 1.0              # count / tfidf minimum document frequency
    categorical: tuple = tuple(CATEGORICAL)
    tags_col: str = "tag_array_lower"
    by_join: bool = False            # labels and terms in tables, found by join (``JoinEncoder``)
    encoded: str | None = None       # a vector column of the rows' own, behind the others

    def with_(self, **kw) -> "FeatureSpec":
        return replace(self, **kw)


def index_stages(cols) -> list:
    """M2: frequency-ranked label index; NULL and unseen get the extra index.

    One multi-column indexer counts every column in a single pass.
    """
    cols = list(cols)
    return [StringIndexer(inputCols=cols, outputCols=[c + "_idx" for c in cols],
                          handleInvalid="keep", stringOrderType="frequencyDesc")]


def one_hot_stages(cols) -> list:
    """M3: one-hot; dropLast removes only the unseen slot (unseen -> all zero)."""
    cols = list(cols)
    return [OneHotEncoder(inputCols=[c + "_idx" for c in cols],
                          outputCols=[c + "_ohe" for c in cols], dropLast=True)]


def text_stages(spec: FeatureSpec, vocab_size: int | None = None) -> tuple[list, str | None]:
    """M4-M6: hashed term counts, exact vocabulary counts, or TF-IDF.

    ``CountVectorizer`` holds its vocabulary on the driver and in the model, as
    ``StringIndexer`` its labels; beyond that ``FeatureSpec(by_join=True)`` keeps
    both in tables (``ml/encoder.py``); hashing needs none.
    """
    if spec.text is None:
        return [], None
    if spec.text == "hashing":
        return [HashingTF(inputCol=spec.tags_col, outputCol="tag_vec",
                          numFeatures=spec.num_features)], "tag_vec"
    if not (vocab_size or spec.vocab_size):
        raise ValueError("count and tfidf need vocab_size, or fit_features, which takes it from the rows")
    cv = CountVectorizer(inputCol=spec.tags_col, outputCol="tag_counts",
                         vocabSize=vocab_size or spec.vocab_size, minDF=spec.min_df)
    if spec.text == "count":
        return [cv], "tag_counts"
    if spec.text == "tfidf":
        return [cv, IDF(inputCol="tag_counts", outputCol="tag_tfidf")], "tag_tfidf"
    raise ValueError(f"unknown text encoding {spec.text}")


def vocabulary_size(spec: FeatureSpec, train: DataFrame) -> int:
    """Terms that occur in at least ``min_df`` of the training documents (one at least)."""
    docs = train.select(F.lit(0).alias("_d"), spec.tags_col)
    return max(1, document_frequency(docs, "_d", spec.tags_col, spec.min_df).count())


def encoding_pipeline(spec: FeatureSpec = FeatureSpec(),
                      vocab_size: int | None = None) -> tuple[Pipeline, str | None]:
    """M8 without the final assembly: index -> one-hot -> text vector.

    Returns the pipeline and the name of its text-vector column.
    """
    cats = list(spec.categorical)
    text, text_col = text_stages(spec, vocab_size)
    return Pipeline(stages=(index_stages(cats) + one_hot_stages(cats) if cats else []) + text), text_col


def assembler(spec: FeatureSpec, text_col: str | None) -> VectorAssembler:
    """M7: tags first, then the one-hot blocks."""
    blocks = [c + "_ohe" for c in spec.categorical] + ([spec.encoded] if spec.encoded else [])
    return VectorAssembler(inputCols=([text_col] if text_col else []) + blocks, outputCol="features", handleInvalid="keep")


ENCODED = "_encoded"


def categorical_vectors(cats: tuple, train: DataFrame, out: str) -> PipelineModel:
    """M2 and M3 of ``cats``, fitted on ``train``, with the one-hot blocks in one vector ``out``."""
    blocks = VectorAssembler(inputCols=[c + "_ohe" for c in cats], outputCol=out, handleInvalid="keep")
    return Pipeline(stages=index_stages(cats) + one_hot_stages(cats) + [blocks]).fit(train)


def feature_pipeline(spec: FeatureSpec = FeatureSpec()) -> Pipeline:
    """M8: index -> one-hot -> text vector -> assemble, without compaction."""
    enc, text_col = encoding_pipeline(spec)
    return Pipeline(stages=enc.getStages() + [assembler(spec, text_col)])


# ------------------------------------------------ distributed label tables

def label_index(df: DataFrame, col: str) -> DataFrame:
    """M2 as a table: ``(value, idx, count)`` ranked by count desc, value asc.

    The same order as ``StringIndexer(stringOrderType='frequencyDesc')``; NULL
    is not a label (it maps to the extra index ``numLabels``).  Ranked with a
    distributed running count, so a vocabulary of any size never sits in one
    task.
    """
    from ..operators.rank import cumulative_before
    vc = (df.select(F.col(col).cast("string").alias("value")).where(F.col("value").isNotNull())
          .groupBy("value").agg(F.count(F.lit(1)).alias("count")))
    ranked = cumulative_before(vc, [F.col("count").desc(), F.col("value").asc()], out="idx")
    return ranked.select("value", "idx", "count")


def document_frequency(df: DataFrame, doc_col: str, terms_col: str,
                       min_df: float = 1.0) -> DataFrame:
    """M5/M6 in long form: ``(term, df, idf)`` with idf = ln((m + 1) / (df + 1)).

    ``min_df`` >= 1 is a document count, < 1 a fraction of documents (as
    CountVectorizer).  Terms are de-duplicated per document map-side.
    """
    docs = df.select(doc_col, F.array_distinct(F.col(terms_col)).alias("_terms"))
    m = df.agg(F.count(F.lit(1))).scalar()
    dfreq = (docs.select(F.explode("_terms").alias("term"))
             .groupBy("term").agg(F.count(F.lit(1)).alias("df")))
    thr = F.lit(float(min_df)) if min_df >= 1 else F.lit(float(min_df)) * m
    return (dfreq.where(F.col("df") >= thr)
            .select("term", "df", F.log((m + 1).cast("double") / (F.col("df") + 1)).alias("idf")))


def active_buckets(spec: FeatureSpec, train: DataFrame) -> list[int]:
    """Hash buckets that some training tag falls into: at most ``num_features``.

    The distinct tags are hashed, not the rows' vectors, and only distinct
    bucket numbers meet.
    """
    tags = train.select(F.explode(spec.tags_col).alias("t")).distinct().select(F.array("t").alias(spec.tags_col))
    (stage,), col = text_stages(spec)
    hit = stage.transform(tags).select(F.explode(vector_entries(col)).alias("e")).select(F.col("e.index").alias("i")).distinct()
    return sorted(r.i for r in hit.collect())


def fit_features(spec: FeatureSpec, train: DataFrame,
                 keep: list[str] | None = None) -> tuple[PipelineModel, int, DataFrame]:
    """Fit the feature pipeline on training rows, without empty hash buckets.

    Hashing to 262144 buckets leaves almost all of them empty.  A column that
    is zero on all training rows cannot be split on by a tree and gets a zero
    coefficient from standardized least squares, so removing it changes no
    prediction - but Spark's tree learner bins every column of every row, the
    linear solvers carry every coefficient, and assembling a 262144-wide vector
    writes one metadata attribute per slot into the schema.  So the hashed
    vector is sliced *before* assembly to the buckets of the training tags.
    Every term of a fitted vocabulary and every label of a fitted indexer occurs
    in the training rows, so those need no slicing.

    With ``by_join`` the model is a ``JoinEncoder``: no label or term comes to the
    driver.  Returns the fitted model, the width the uncompacted vector would have, and
    the training rows (``features`` plus ``keep``), persisted; the caller
    unpersists them.
    """
    keep = list(keep or [])
    if spec.by_join:
        from .encoder import JoinEncoder
        encoder = JoinEncoder.fit(spec, train)
        rows = encoder.transform(train.select(*dict.fromkeys([*spec.categorical, *([spec.tags_col] if spec.text else []), *keep])))
        return encoder, encoder.width, rows.select("features", *keep).persist(StorageLevel.MEMORY_AND_DISK)
    counted = spec.text in ("count", "tfidf")
    vocab = (spec.vocab_size or vocabulary_size(spec, train)) if counted else None
    enc, text_col = encoding_pipeline(spec, vocab)
    pm = enc.fit(train)
    width = sum(next((st.categorySizes for st in pm.stages if hasattr(st, "categorySizes")), []))
    stages = list(pm.stages)
    if spec.text == "hashing":
        stages.append(VectorSlicer(inputCol=text_col, outputCol=text_col + "_active",
                                   indices=active_buckets(spec, train) or [0]))
        width += spec.num_features
        text_col += "_active"
    elif counted:
        width += next(len(st.vocabulary) for st in pm.stages if hasattr(st, "vocabulary"))
    model = PipelineModel(stages + [assembler(spec, text_col)])
    rows = model.transform(train).select("features", *keep).persist(StorageLevel.MEMORY_AND_DISK)
    return model, width, rows
