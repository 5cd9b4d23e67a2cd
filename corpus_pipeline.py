"""Corpus pipeline over ``documents``: rules, classifier, near-duplicates, mixture, packing.

Every stage works on all rows of the stage before, reread from Parquet. All but the last return the columns they got. The
classifier and the mixture learn from the labelled texts of the whole table: what earlier stages have dropped still teaches.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockwatch.llm.common import read_table
from dockwatch.llm.op01_gam import held_out, keep_good
from dockwatch.llm.op02_packing import pack_documents
from dockwatch.llm.op05_rules import keep_passing
from dockwatch.llm.op06_neardup import keep_one
from dockwatch.llm.op08_mixing import mix_rows
from dockwatch.llm.queries import MIXTURE, domain_labels
from dockwatch.llm.tokens import tokenizer_file
from dockwatch.session import materialise, new_folder

#: Folders of the reports that the mixture stages of this process have written: wanted and reached share of every target.
MIXTURE_REPORTS = []
#: Rate of a document in the mixture at most.
MOST_COPIES = 16


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects."""
    return keep_passing(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.3 or more, learnt from all labelled documents (never from held-out ids)."""
    return keep_good(docs, read_table(spark, sf_dir, "labels"), taught_by=read_table(spark, sf_dir, "documents"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose sets of five-word shingles are linked at 0.8 or more."""
    return keep_one(docs, k=5, num=4, den=5)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the fitted rates say; the shares that were reached are written to a report."""
    labels = read_table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    MIXTURE_REPORTS.append(new_folder(spark, "mixture-report"))
    return mix_rows(docs, domain_labels(labels), MIXTURE, taught_by=read_table(spark, sf_dir, "documents"), cap=MOST_COPIES,
                    report_path=MIXTURE_REPORTS[-1])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Length bucket, batch and slot of every document that is left, once per copy."""
    return pack_documents(docs, tokenizer_file())


STAGES = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("near-duplicates", near_duplicates),
    ("mixture", mixture),
    ("packing", packing),
]
#: The tokenizer, the classifiers and the similarity groups cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; the results between stages lie in the shared folder."""
    docs = read_table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{number}")
    return docs
