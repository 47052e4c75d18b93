"""Bronze articles to silver articles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.functions.language import Model, with_language
from broadsheet.functions.text import canonical_country, normalize, strip_html
from broadsheet.operators.quality import accepted
from broadsheet.schema import SILVER


def enrich(articles: DataFrame, model: Model) -> DataFrame:
    """Cleaned, normalised and language-tagged copies of already accepted articles."""
    cleaned = articles.withColumns(
        {
            "content_clean": strip_html(F.col("content")),
            "title_clean": strip_html(F.col("title")),
            "country": canonical_country(F.col("country")),
        }
    )
    return (
        with_language(cleaned, "content_clean", model, stripped=True)
        .withColumns(
            {
                "content_normalized": normalize(F.col("content_clean")),
                "title_normalized": normalize(F.col("title_clean")),
                "processed_at": F.current_timestamp(),
            }
        )
        .select(*SILVER.fieldNames())
    )


def to_silver(bronze: DataFrame, model: Model) -> DataFrame:
    return enrich(accepted(bronze), model)
