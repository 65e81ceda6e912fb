"""Bronze tables: registry inputs as deterministic views of the test tables, and readers for delimited and text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

#: Persons without parents in the derived pedigree.
FOUNDERS = 40

DETAIL_SCHEMA = StructType(
    [
        StructField("spm_person_no", StringType()),
        StructField("spm_person_no_father", StringType()),
        StructField("spm_person_no_mother", StringType()),
        StructField("crm_seq", StringType()),
        StructField("rel1_code", IntegerType()),
    ]
)
MASTER_SCHEMA = StructType([StructField("crm_seq", StringType()), StructField("spm_person_no", StringType())])
RELATION_SCHEMA = StructType([StructField("code", IntegerType()), StructField("description", StringType()), StructField("description_eng", StringType())])


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A delimited file with a header, by a declared schema."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_optional_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """As ``read_csv``; a file that is absent, in whatever file system, gives an empty table of the same schema."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target):
        return spark.createDataFrame([], schema)
    return read_csv(spark, path, schema)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Ids, one on each line; blank lines and repeats go."""
    return spark.read.text(path).select(F.trim("value").alias("id")).where("id <> ''").distinct()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _person_no(k: str):
    return F.expr(f"concat('P', lpad(cast({k} as string), 10, '0'))")


def pedigree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, fa, mo): fathers are even, mothers odd, both smaller than k."""
    fa = f"((c_custkey - {FOUNDERS}) div 4) * 2"
    born = F.expr(f"c_custkey >= {FOUNDERS}")
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("k"),
        F.when(born, F.expr(fa)).alias("fa"),
        F.when(born, F.expr(f"{fa} + CASE WHEN c_custkey % 4 = 3 AND ({fa}) % 4 = 0 THEN 29 ELSE 31 END")).alias("mo"),
    )


def person_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Person records: one for each customer, and for every seventh a second registration under another number."""
    c = table(spark, sf_dir, "customer").withColumn("k", F.col("c_custkey"))
    nid = "CASE WHEN k % 13 = 0 THEN '  ' WHEN k % 5 <> 3 THEN concat('784-', lpad(cast(k as string), 7, '0'), ' 1') END"
    dob = "CASE WHEN k % 29 = 5 THEN 'unknown' WHEN k % 11 <> 4 THEN cast(date_add(DATE'1950-01-01', cast(k * 37 % 20000 as int)) as string) END"
    shared = {
        "spm_dob": dob,
        "spm_gender": "CASE WHEN k % 17 <> 9 THEN cast(1 + k % 2 as int) END",
        "nat_code_curr_nat": "c_nationkey",
        "emi_code": "cast(k % 7 as int)",
        "passport": "CASE WHEN k % 4 <> 1 THEN concat('n', cast(100000 + k as string)) END",
        "email": "concat('Person', cast(k as string), '@Example.org')",
        "spm_created_date": "timestampadd(MINUTE, k, TIMESTAMP'2019-01-01 00:00:00')",
    }
    first = {
        "spm_person_no": "concat('P', lpad(cast(k as string), 10, '0'))",
        "spm_full_aname": "concat('ar ', c_name)",
        "spm_full_ename": "CASE WHEN k % 19 <> 2 THEN concat('  ', c_name, ' ') END",
        "spm_national_id": nid,
        "spm_place_of_birth_eng": "c_mktsegment",
        "cit_code": "cast(k % 10 as int)",
        "mobile": "concat('+971 50-', cast(1000000 + k as string))",
        "spm_modified_date": "CASE WHEN k % 3 <> 0 THEN timestampadd(HOUR, k, TIMESTAMP'2020-01-01 00:00:00') END",
    }
    second = first | {
        "spm_person_no": "concat('P', lpad(cast(k + 1000000 as string), 10, '0'))",
        "spm_full_aname": "concat(' AR ', c_name)",
        "spm_national_id": f"replace({nid}, '-', '')",
        "spm_place_of_birth_eng": "CASE WHEN k % 2 = 0 THEN c_mktsegment END",
        "cit_code": "cast(NULL as int)",
        "spm_modified_date": "timestampadd(HOUR, k, TIMESTAMP'2021-01-01 00:00:00')",
    }
    pick = lambda df, cols: df.select("k", *[F.expr(e).alias(n) for n, e in (shared | cols).items()])
    return pick(c, first).unionByName(pick(c.where("k % 7 = 0"), second))


def _detail_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(book, k, fa, mo, rel1): members of the books of all fathers, by pedigree key."""
    p = pedigree(spark, sf_dir).where("fa is not null")
    none = F.lit(None).cast("long")
    heads = p.select(F.col("fa").alias("book"), F.col("fa").alias("k"), none.alias("fa"), none.alias("mo"), F.lit(1).alias("rel1")).distinct()
    wives = p.select(F.col("fa").alias("book"), F.col("mo").alias("k"), none.alias("fa"), none.alias("mo"), F.lit(2).alias("rel1")).distinct()
    children = p.select(F.col("fa").alias("book"), "k", "fa", "mo", F.when(F.col("k") % 2 == 0, 3).otherwise(4).alias("rel1"))
    return heads.unionByName(wives).unionByName(children)


def record_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Book members; some children are entered under their second registration."""
    d = _detail_keys(spark, sf_dir)
    me = F.when((F.col("rel1") >= 3) & (F.col("k") % 14 == 0), F.col("k") + 1000000).otherwise(F.col("k"))
    return d.withColumn("me", me).select(
        _person_no("me").alias("spm_person_no"),
        _person_no("fa").alias("spm_person_no_father"),
        _person_no("mo").alias("spm_person_no_mother"),
        F.expr("concat('F', lpad(cast(book as string), 6, '0'))").alias("crm_seq"),
        F.col("rel1").cast("int").alias("rel1_code"),
    )


def record_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Books and their heads."""
    return _detail_keys(spark, sf_dir).where("rel1 = 1").select(F.expr("concat('F', lpad(cast(book as string), 6, '0'))").alias("crm_seq"), _person_no("k").alias("spm_person_no"))


def residency_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = {
        "sponsor_number": "CASE WHEN o_custkey % 9 = 4 THEN concat('R', lpad(cast(o_custkey % 200 as string), 8, '0')) WHEN o_custkey % 23 <> 1 THEN concat('P', lpad(cast(o_custkey as string), 10, '0')) END",
        "id": "o_orderkey",
        "english_full_name": "CASE WHEN o_orderkey % 6 <> 5 THEN concat(' Resident ', cast(o_orderkey as string)) END",
        "arabic_full_name": "concat('ar resident ', cast(o_orderkey as string))",
        "date_of_birth": "cast(date_add(DATE'1960-01-01', cast(o_orderkey * 13 % 15000 as int)) as string)",
        "passport_number": "CASE WHEN o_orderkey % 4 <> 1 THEN concat('p-', cast(o_orderkey % 900 as string), ' x') END",
        "local_mobile_number": "concat('050', cast(o_orderkey as string))",
        "email_address": "concat('r', cast(o_orderkey as string), '@example.org')",
        "lookup_curr_nationality_id": "cast(o_custkey % 25 as int)",
        "lookup_gender_id": "CASE WHEN o_orderkey % 15 <> 7 THEN cast(1 + o_orderkey % 2 as int) END",
        "lookup_family_relationship_id": "substring(o_orderpriority, 1, 1)",
        "creation_date": "cast(o_orderdate as timestamp)",
    }
    return table(spark, sf_dir, "orders").select(*[F.expr(e).alias(n) for n, e in cols.items()])


def family_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").selectExpr("cast(r_regionkey as string) as id", "100 + r_regionkey as name_id")


def value_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "region")
    of = lambda n: r.select((F.col("r_regionkey") + 100).alias("value_language_group_id"), F.lit(n).alias("lookup_language_id"), F.concat(F.lower("r_name"), F.lit(f"_{n}")).alias("localized_value"))
    return of(1).unionByName(of(2))


def request_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr("o_orderkey as id", "CASE WHEN o_orderstatus = 'F' OR o_orderkey % 3 = 0 THEN 6 ELSE 4 END as lookup_last_action_id")


def request_applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr("l_orderkey as request_id", "l_orderkey * 10 + l_linenumber as udb_transaction_no", "2000 + l_linenumber as udb_transaction_year", "CASE WHEN l_linenumber <= 2 THEN 1 ELSE 2 END as lookup_module_id")


def residency_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey * 10 + l_linenumber as rtr_no",
        "2000 + l_linenumber as rtr_year",
        "CASE WHEN l_orderkey % 5 <> 2 THEN concat('R', lpad(cast(l_orderkey as string), 8, '0')) END as spm_person_no",
        "CASE WHEN l_linenumber <> 2 THEN cast(l_shipdate as timestamp) END as rtr_create_date",
        "l_linenumber as rma_seqno",
        "2000 + l_linenumber as rma_year",
    )
