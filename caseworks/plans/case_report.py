"""The case analysis in order: themes, labels, sentiment, spikes, durations, repeat contact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from caseworks.functions.text import STOP_WORDS
from caseworks.operators import contacts, durations, incidents, sentiment, themes
from caseworks.operators.tfidf import fit_tfidf
from caseworks.session import checkpoint_folder


def case_report(
    cases: DataFrame, id_col: str, text: str, opened: str, contact: str, hours: str, lexicon: DataFrame,
    k: int = 12, min_df: int = 3, max_features: int = 20_000, stop_words: Sequence[str] = STOP_WORDS, z: float = 3.0,
) -> dict[str, DataFrame]:
    """TF-IDF themes of all cases (no sampling) and the reports by theme, each a lazy DataFrame.

    The narrow case table with themes is stored once in the checkpoint folder and serves all
    reports; texts and their vectors are never shuffled. ``centres`` are those of the fitted model,
    so new cases can be assigned to the same themes; the keywords come from them.
    """
    checkpoint_folder(cases.sparkSession)
    model = fit_tfidf(cases, text, min_df=min_df, max_features=max_features, stop_words=stop_words)
    vectors = model.transform(cases.select(id_col, text), text).drop(text)
    assigned, centres = themes.kmeans_with_centres(vectors, id_col, "features", k=k)
    themed = cases.select(id_col, contact, opened, hours).join(assigned, id_col).checkpoint()
    keywords = themes.centre_keywords(centres, model)
    scored = sentiment.lexicon_sentiment(cases, id_col, text, lexicon).join(assigned, id_col)
    history = contacts.repeat_contacts(themed, contact, opened, id_col)
    labels = keywords.withColumnRenamed("keywords", "label")
    return {
        "themes": assigned,
        "centres": centres,
        "keywords": keywords,
        "sizes": themes.cluster_counts(assigned, "theme"),
        "sentiment": sentiment.sentiment_by_theme(
            scored, "theme", "compound", sentiment.is_upset("compound"), labels=labels
        ),
        "spikes": incidents.theme_spikes(themed, opened, "theme", z=z),
        "durations": durations.ttr_by_theme(themed, "theme", hours),
        "repeat": contacts.repeat_by_theme(history, "theme"),
    }
