"""Features for coded records: routing, hashing, encoding, assembly."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.ml.feature import HashingTF, VectorAssembler, VectorSizeHint
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseworks.functions.clean import to_number
from caseworks.functions.text import tokens
from caseworks.plans.bounded import lookup_join
from caseworks.plans.ranks import sorted_codes

# Bucket counts of whole-value hashing and the token of a missing value.
CATEGORY_BUCKETS = 32
TEXT_BUCKETS = 128
MISSING_VALUE = "__MISSING__"


@dataclass(frozen=True)
class FeatureRouting:
    """Which columns are numeric, categorical and text; learned on train, stored beside the model."""

    numeric: list[str] = field(default_factory=list)
    categorical: list[str] = field(default_factory=list)
    text: list[str] = field(default_factory=list)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> FeatureRouting:
        return FeatureRouting(**json.loads(text))

    def table(self, df: DataFrame) -> DataFrame:
        rows = [(c, kind) for kind, cols in asdict(self).items() for c in cols]
        return df.sparkSession.createDataFrame(rows, "column string, kind string")


def route_features(schema: T.StructType, features: Sequence[str], rule: str = "A") -> FeatureRouting:
    """Rule A: numbers and booleans are numeric, names with "desc" text, the rest categorical.

    Rule B: strings whose name contains text, desc or line are text, other strings
    categorical, everything else numeric.
    """
    routing = FeatureRouting()
    for name in features:
        kind = schema[name].dataType
        lower = name.lower()
        if rule == "A":
            numeric = isinstance(kind, (T.NumericType, T.BooleanType))
            is_text = "desc" in lower
        else:
            numeric = not isinstance(kind, T.StringType)
            is_text = any(part in lower for part in ("text", "desc", "line"))
        (routing.numeric if numeric else routing.text if is_text else routing.categorical).append(name)
    return routing


def fill_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """NULL numbers become 0, everything else NULL becomes ''."""
    numbers = [c for c in features if isinstance(df.schema[c].dataType, T.NumericType)]
    others = [c for c in features if c not in numbers]
    filled = df.select(
        *[
            F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in others else F.col(c)
            for c in df.columns
        ]
    )
    return filled.na.fill(0, numbers) if numbers else filled


def hash_text(df: DataFrame, col: str, n_features: int = 1024, out: str | None = None) -> DataFrame:
    """Bag of hashed words: unsigned counts, not normalised, NULL is the empty text."""
    words = df.withColumn("_words", tokens(col))
    return HashingTF(numFeatures=n_features, inputCol="_words", outputCol=out or f"{col}_hash").transform(
        words
    ).drop("_words")


def md5_bucket(value: Column, n: int) -> Column:
    """Bucket that any SQL engine can recompute: first 32 bits of the md5 modulo ``n``."""
    return F.pmod(F.conv(F.substring(F.md5(value), 1, 8), 16, 10).cast("long"), F.lit(n)).cast("int")


def hash_text_long(df: DataFrame, id_col: str, col: str, n_features: int) -> DataFrame:
    """(id, bucket, count) with portable buckets; the words of a text are combined before the shuffle."""
    words = df.select(id_col, F.explode(tokens(col)).alias("word"))
    return words.groupBy(id_col, md5_bucket(F.col("word"), n_features).alias("bucket")).agg(
        F.count(F.lit(1)).alias("count")
    )


def hash_value_parts(col: str, n_features: int) -> tuple[Column, Column]:
    """Bucket and sign (+1/-1) of a whole cell value; both from one md5, hence portable."""
    value = F.coalesce(F.col(col).cast("string"), F.lit(MISSING_VALUE))
    odd = F.conv(F.substring(F.md5(value), 9, 1), 16, 10).cast("int") % 2
    return md5_bucket(value, n_features), F.when(odd == 1, -1.0).otherwise(1.0)


def hash_value(df: DataFrame, col: str, n_features: int = CATEGORY_BUCKETS, signed: bool = True,
               out: str | None = None) -> DataFrame:
    """The entire cell is one token: a vector with a single +1 or -1."""
    bucket, sign = hash_value_parts(col, n_features)
    value = sign if signed else F.lit(1.0)
    zero, b = F.lit(0.0), F.col("_b")
    slots = F.concat(F.array_repeat(zero, b), F.array("_s"), F.array_repeat(zero, F.lit(n_features - 1) - b))
    out = out or f"{col}_hash"
    staged = df.withColumn("_b", bucket).withColumn("_s", value)
    vectors = staged.withColumn(out, array_to_vector(slots)).drop("_b", "_s")
    # The width is known, so the assembler need not look at a first row.
    return VectorSizeHint(inputCol=out, size=n_features, handleInvalid="optimistic").transform(vectors)


def numeric_block(df: DataFrame, cols: Sequence[str], suffix: str = "") -> DataFrame:
    """Numbers with NULL and unparsable values as 0."""
    return df.withColumns({c + suffix: _number(df, c) for c in cols})


def _number(df: DataFrame, col: str) -> Column:
    """``to_number``, without the way over text where a type gives the same number directly (a float's text is another double)."""
    if not isinstance(df.select(col).schema[0].dataType, (T.DoubleType, T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return to_number(col)
    number = F.col(col).cast("double")
    return F.when(number.isNotNull() & ~F.isnan(number), number).otherwise(F.lit(0.0))


def label_map(df: DataFrame, label: str = "label") -> DataFrame:
    """(label, index): rank among the sorted distinct label strings."""
    return sorted_codes(df.select(F.col(label).cast("string").alias("label")), "label", "index")


def num_class(labels: DataFrame) -> int:
    """Classes of a label map: highest index + 1."""
    return (labels.agg(F.max("index")).first()[0] or 0) + 1 if not labels.isEmpty() else 0


def category_codes(train: DataFrame, col: str, unseen: str = "zero", unknown: str = "Unknown") -> DataFrame:
    """Code table of a category fitted on ``train``; mode "unknown" reserves a class for unseen values."""
    fill = "" if unseen == "zero" else unknown
    values = train.select(F.coalesce(F.col(col).cast("string"), F.lit(fill)).alias(col))
    return sorted_codes(values, col)


def encode_category(
    df: DataFrame, codes: DataFrame, col: str, spread_by: Sequence[str], unseen: str = "zero",
    unknown: str = "Unknown", out: str | None = None,
) -> DataFrame:
    """Replace a category by its code.

    ``zero``: NULL is '' and an unseen value gets code 0. ``unknown``: NULL and unseen
    values get the code of "Unknown", appended last when it is not a real class.
    """
    fill = "" if unseen == "zero" else unknown
    out = out or f"{col}_code"
    keyed = df.withColumn("_value", F.coalesce(F.col(col).cast("string"), F.lit(fill)))
    table = codes.select(F.col(col).alias("_value"), F.col("code").alias("_code"))
    if unseen == "zero":
        default = F.lit(0)
    else:
        found = codes.agg(F.max(F.when(F.col(col) == unknown, F.col("code"))), F.max("code")).first()
        default = F.lit(found[0] if found[0] is not None else (found[1] if found[1] is not None else -1) + 1)
    joined = lookup_join(keyed, table, ["_value"], spread_by, "left")
    return joined.withColumn(out, F.coalesce("_code", default).cast("long")).drop("_value", "_code")


def expand_vector(df: DataFrame, vec: str, prefix: str, size: int, drop: bool = True) -> DataFrame:
    """Vector to columns ``{prefix}_{i}``, for export only."""
    values = df.withColumn("_a", vector_to_array(vec))
    wide = values.withColumns({f"{prefix}_{i}": F.col("_a")[i] for i in range(size)}).drop("_a")
    return wide.drop(vec) if drop else wide


def assemble(df: DataFrame, blocks: Sequence[str], out: str = "features") -> DataFrame:
    """Blocks side by side in the given order."""
    return VectorAssembler(inputCols=list(blocks), outputCol=out).transform(df)


def featurize(df: DataFrame, routing: FeatureRouting, out: str = "features", keep_blocks: bool = False) -> DataFrame:
    """Hashed features of rule A: numeric, then categorical, then text blocks. Stateless, so no fit.

    Categories and texts are hashed as whole values with a sign.
    """
    staged = numeric_block(df, routing.numeric, suffix="_num")
    blocks = [f"{c}_num" for c in routing.numeric]
    for cols, width in ((routing.categorical, CATEGORY_BUCKETS), (routing.text, TEXT_BUCKETS)):
        for c in cols:
            staged = hash_value(staged, c, width)
            blocks.append(f"{c}_hash")
    done = assemble(staged, blocks, out)
    return done if keep_blocks else done.drop(*blocks)


def featurize_words(df: DataFrame, routing: FeatureRouting, n_features: int = 2000, out: str = "features") -> DataFrame:
    """Tokenised variant: numbers, whole-value hashed categories, hashed bags of words."""
    staged = numeric_block(df, routing.numeric, suffix="_num")
    blocks = [f"{c}_num" for c in routing.numeric]
    for c in routing.categorical:
        staged = hash_value(staged, c)
        blocks.append(f"{c}_hash")
    for c in routing.text:
        staged = hash_text(staged, c, n_features, out=f"{c}_words")
        blocks.append(f"{c}_words")
    return assemble(staged, blocks, out).drop(*blocks)


def fit_encoders(train: DataFrame, routing: FeatureRouting, unseen: str = "zero") -> dict[str, DataFrame]:
    """Code table per categorical column, fitted on ``train``."""
    return {c: category_codes(train, c, unseen) for c in routing.categorical}


def featurize_encoded(
    df: DataFrame, routing: FeatureRouting, encoders: dict[str, DataFrame], spread_by: Sequence[str],
    order: Sequence[str] | None = None, n_features: int = 2000, unseen: str = "zero", out: str = "features",
) -> DataFrame:
    """Encoded variant: numbers, category codes and hashed bags of words, blocks in ``order`` of their columns."""
    staged = numeric_block(df, routing.numeric, suffix="_block")
    for c in routing.categorical:
        staged = encode_category(staged, encoders[c], c, spread_by, unseen, out=f"{c}_block")
    for c in routing.text:
        staged = hash_text(staged, c, n_features, out=f"{c}_block")
    order = list(order or [*routing.numeric, *routing.categorical, *routing.text])
    blocks = [f"{c}_block" for c in order]
    return assemble(staged, blocks, out).drop(*blocks)
