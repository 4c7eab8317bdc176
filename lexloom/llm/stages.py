"""Pipeline stages: (spark, docs, sf_dir) to a DataFrame; all but the last keep the columns of ``docs``.

Defined results, for every stage: nulls in any column are allowed (a null text counts as empty; a null
id is never another's; columns of ``docs`` named like those that an operator adds are kept as they were);
texts of any length are taken whole; repeated rows are judged each, but the near-duplicate stage leaves
one of them; ties go by id, then by a hash of the text; ids become long; an empty table gives an empty
one.  The classifier and the rules judge rows alone, and a text that is empty fails the rules' base.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lexloom.llm import line_dedup as lines, near_copies, packing as packs, quality_model, quality_rules as rules


def _with_text(docs: DataFrame, judged: DataFrame, text: str) -> DataFrame:
    """The columns of ``docs`` with another text, and its length in code points."""
    out = {"text": F.col(text)}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType)
    return judged.withColumns(out).select(docs.columns)


def quality_classifier(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for low quality go."""
    scored = quality_model.score(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.where("predicted = 1").select(docs.columns)


def quality_rules(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go; from the others, lines above their host's limit go."""
    return _with_text(docs, rules.judged(docs).where("kept"), "cleaned")


def line_dedup(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shared lines go from the texts; documents left without a word go too."""
    return _with_text(docs, lines.dedup_lines(docs).where(F.col("text").rlike(r"[^\x20\x09-\x0D]")), "text")


def simhash_near_dedup(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near copies stays (5-word Jaccard of 0.8 or more), that with the smallest id."""
    return near_copies.one_of_each(docs)


def packing(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document that is left, in its length bucket and batch, by tokens."""
    return packs.pack_tokens(docs)
