"""Songs in, stanzas out."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import clean_brackets, drop_uninformative, split_stanzas, strip_header, tokenize
from ..operators.rows import argmax_columns, exclude_value, one_hot
from ..operators.sampling import stratified_sample
from ..operators.sections import dedup_keep_first, explode_stanzas
from ..operators.terms import derive_lemmas, lemmatize
from ..operators.unnest import unnest
from ..sources.staging import stage
from ..wordlists import GENRES

LANGUAGE_COLUMNS = ["language_cld3", "language_ft", "language"]


def sample_songs(songs: DataFrame, frac: float = 0.05, id_col: str = "id", seed: int = 42) -> DataFrame:
    """A fixed share of each genre, with the genre as ``is_<genre>`` columns.

    A song without any genre flag counts as ``misc`` and is left out.
    """
    flags = [f"is_{g}" for g in GENRES]
    some = F.greatest(*[F.coalesce(F.col(f), F.lit(False)) for f in flags])
    tagged = songs.drop(*LANGUAGE_COLUMNS).withColumn(
        "tag", F.when(some, argmax_columns(flags, GENRES)).otherwise("misc"))
    kept = exclude_value(tagged, "tag", "misc")
    return one_hot(stratified_sample(kept, "tag", frac, id_col, seed), "tag", "is", GENRES)


def split_songs(songs: DataFrame, text: str = "lyrics") -> DataFrame:
    """One row per informative stanza: ``stanzas``, ``stanza_number``, ``is_chorus``, headers cut off.

    Cleaning, splitting, numbering and the repeat flag all happen inside the song's row.
    """
    sections = drop_uninformative(split_stanzas(clean_brackets(F.col(text))))
    rows = explode_stanzas(songs.withColumn("_sections", sections).drop(text), "_sections", chorus="is_chorus")
    return rows.withColumn("stanzas", strip_header(F.col("stanzas")))


def unique_stanzas(stanzas: DataFrame, id_col: str = "id") -> DataFrame:
    return dedup_keep_first(stanzas, ["title", "artist", "stanzas", "is_chorus"], [id_col, "stanza_number"])


def stanza_table(songs: DataFrame, lemmas: DataFrame | None = None, id_col: str = "id",
                 keep_text: bool = False) -> DataFrame:
    """Songs to lemmatised, de-duplicated stanzas.

    Without a lemma table one is derived from the words of the songs.
    """
    unique = stage(unique_stanzas(split_songs(songs), id_col).withColumn("_tokens", tokenize(F.col("stanzas"))))
    if lemmas is None:
        lemmas = stage(derive_lemmas(unnest(unique, [], "_tokens", "token")))
    out = lemmatize(unique, [id_col, "stanza_number"], "_tokens", lemmas, "lemmatized_stanzas").drop("_tokens")
    return out if keep_text else out.drop("stanzas")
