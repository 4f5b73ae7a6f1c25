"""Display names of classes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Class id to display name.
CLASS_NAMES = {
    0: "Human-written text",
    1: "DeepSeek generated text",
    2: "Grok generated text",
    3: "Claude generated text",
    4: "Gemini generated text",
    5: "ChatGPT generated text",
}


def with_class_name(df: DataFrame, label_col: str, names=CLASS_NAMES, name: str = "class_name") -> DataFrame:
    """Append the name of each class by a lookup in a literal map; unknown ids get null."""
    pairs = [F.lit(x) for pair in names.items() for x in pair]
    return df.withColumn(name, F.try_element_at(F.create_map(*pairs), F.col(label_col)))
