"""Tables of relational databases through Spark's jdbc source and sink, and the lookups made of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.config import Database
from folioforge.functions.text import basename
from folioforge.operators.evaluate import last_wins


def read(spark: SparkSession, db: Database, table: str, by: tuple[str, int, int, int] | None = None) -> DataFrame:
    """A table; columns and filters are pushed down. by: a whole-number column, its bounds and the number of parallel reads."""
    options = db.options(table)
    if by:
        options |= dict(zip(("partitionColumn", "lowerBound", "upperBound", "numPartitions"), map(str, by)))
    return spark.read.format("jdbc").options(**options).load()


def replace(df: DataFrame, db: Database, table: str) -> None:
    """Truncate and insert: the table's own types and grants stay."""
    df.write.format("jdbc").options(**db.options(table), truncate="true").mode("overwrite").save()


def upsert(df: DataFrame, db: Database, table: str, keys: list[str]) -> None:
    """Rows of df in place of those of the same key: what the table keeps is read before it is replaced."""
    from folioforge.operators.load import upsert as merged

    merged_rows = merged(read(df.sparkSession, db, table), df.withColumn("_o", F.lit(0)), keys, ["_o"])
    replace(merged_rows.checkpoint(), db, table)  # the read ends before the table is emptied


def filename_map(spec_doc: DataFrame, document: DataFrame) -> DataFrame:
    """filename, cis: links joined to documents' paths; of several links of a name the greatest by document and code wins."""
    rows = spec_doc.select("DocId", F.col("SpecId").cast("string").alias("cis")).join(document.select("DocId", basename(F.col("DocPath")).alias("filename")), "DocId")
    return last_wins(rows.select("filename", "cis", "DocId"), ["filename"], ["DocId", "cis"]).drop("DocId")


def authorised(specialite: DataFrame) -> DataFrame:
    """cis of the authorised rows."""
    return specialite.filter("isBdm").select(F.col("SpecId").cast("string").alias("cis")).distinct()


def names(specialite: DataFrame) -> DataFrame:
    """cis, name of the authorised rows."""
    rows = specialite.filter("isBdm").select(F.col("SpecId").cast("string").alias("cis"), F.col("SpecDenom01").alias("name"))
    return last_wins(rows.withColumn("_o", F.col("name")), ["cis"], ["_o"]).drop("_o")


def code_map(cis_atc: DataFrame) -> DataFrame:
    """cis, code: one code per cis, the greatest (the source has no order)."""
    return cis_atc.groupBy(F.col("code_cis").cast("string").alias("cis")).agg(F.max("code_terme_atc").alias("code"))


def reference_tables(spark: SparkSession, db: Database) -> dict[str, DataFrame]:
    """groups, substances, pathologies and labels, as specialite_docs() takes them."""
    pick = lambda table, code, label: read(spark, db, table).select(F.col(code).alias("code"), F.col(label).alias("label"))
    labels = pick("atc", "code", "label_court").unionByName(pick("ref_atc_friendly_niveau_1", "code", "libelle")).unionByName(pick("ref_atc_friendly_niveau_2", "code", "libelle"))
    groups = read(spark, db, "resume_medicaments").select("specialites", F.col("subsIds").alias("subs_ids"), F.col("pathosCodes").alias("pathos_codes"), F.col("atc5Code").alias("atc5_code"))
    return {"groups": groups, "substances": pick("resume_substances", "NomId", "NomLib"), "pathologies": pick("resume_pathologies", "codePatho", "NomPatho"), "labels": labels.dropna()}
