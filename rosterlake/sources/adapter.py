"""HR, payroll, company and bookstore tables derived from the star-schema benchmark tables.

Every view covers all rows of its source table. Column arithmetic on the key only makes
values (NULL genders, missing pay rows, duplicate e-mails); it never selects rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .loading import Tables, load_table

MONEY = "decimal(12,2)"


def _when_not(missing: Column, value: Column) -> Column:
    return F.when(~missing, value)


def employee(customer: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    job = F.col("c_nationkey").cast("bigint")
    shared_mail = key - (key % 50 == 49).cast("bigint")
    return customer.select(
        key.alias("emp_id"),
        F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("last_name"),
        _when_not(key % 10 == 9, F.when(key % 2 == 0, "M").otherwise("F")).alias("gender"),
        (18 + key % 60).cast("int").alias("age"),
        _when_not(key % 11 == 10, F.concat(F.lit("user"), shared_mail, F.lit("@example.com"))).alias(
            "email"
        ),
        F.concat(F.lit("555-"), F.lpad((key % 10000).cast("string"), 4, "0")).alias("phone"),
        F.date_add(F.lit("2010-01-01").cast("date"), (key % 5000).cast("int")).alias("hire_date"),
        _when_not(job == 24, job).alias("job_id"),
        _when_not(key % 17 == 16, key).alias("salary_id"),
    )


def job_department(nation: DataFrame) -> DataFrame:
    return nation.select(
        F.col("n_nationkey").cast("bigint").alias("job_id"),
        F.col("n_name").alias("dept_name"),
        F.concat(F.col("n_name"), F.lit(" department")).alias("dept_description"),
        F.concat(F.lit("R"), F.col("n_regionkey")).alias("salary_range"),
        F.lit("2010-01-01").cast("date").alias("created_date"),
    )


def salary_bonus(part: DataFrame) -> DataFrame:
    key = F.col("p_partkey")
    size = F.col("p_size")
    return part.select(
        key.alias("salary_id"),
        F.col("p_retailprice").cast(MONEY).alias("amount"),
        _when_not(key % 10 == 7, size.cast(MONEY)).alias("bonus_amount"),
        (size % 8).cast("decimal(5,2)").alias("annual_increase"),
        (size % 25).cast("bigint").alias("job_id"),
        F.lit("2010-01-01").cast("date").alias("created_date"),
    )


def payroll_columns() -> list[Column]:
    """The payroll columns as expressions over orders."""
    gross = F.col("o_totalprice").cast(MONEY)
    deductions = F.round(gross * F.lit("0.20").cast("decimal(3,2)"), 2).cast(MONEY)
    job = F.col("o_custkey") % 25
    status = F.col("o_orderstatus")
    return [
        F.col("o_orderkey").alias("payroll_id"),
        F.col("o_orderdate").cast("date").alias("payroll_date"),
        gross.alias("gross_amount"),
        deductions.alias("deductions"),
        (gross - deductions).cast(MONEY).alias("net_amount"),
        F.col("o_custkey").alias("emp_id"),
        _when_not(job == 24, job).alias("job_id"),
        F.col("o_custkey").alias("salary_id"),
        _when_not(F.col("o_orderkey") % 3 != 0, F.col("o_orderkey")).alias("leave_id"),
        F.when(status == "O", "PENDING").when(status == "F", "PROCESSED").otherwise("PAID").alias(
            "payment_status"
        ),
    ]


def payroll(orders: DataFrame) -> DataFrame:
    return orders.select(*payroll_columns())


def leave(events: DataFrame) -> DataFrame:
    key = F.col("event_id")
    user = F.col("user_id")
    kind = F.col("event_type")
    start = F.col("ts").cast("date")
    state = key % 3
    return events.select(
        key.alias("leave_id"),
        F.when(kind == "error", "SICK").when(kind == "click", "VACATION").otherwise(
            F.upper(kind)
        ).alias("leave_type"),
        start.alias("leave_start"),
        _when_not(key % 10 == 0, F.date_add(start, (key % 7).cast("int"))).alias("leave_end"),
        F.col("props").alias("reason"),
        F.when(state == 0, "PENDING").when(state == 1, "APPROVED").otherwise("REJECTED").alias(
            "status"
        ),
        F.when(key % 97 == 5, -1 - user).otherwise(user).alias("emp_id"),
        _when_not(key % 10 == 3, F.floor(user / 10).cast("bigint")).alias("approved_by"),
    )


def qualification(lineitem: DataFrame) -> DataFrame:
    flag = F.col("l_returnflag")
    return lineitem.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("qual_id"),
        F.concat(F.lit("Course "), F.col("l_partkey")).alias("qual_title"),
        F.when(flag == "A", "CERTIFICATION").when(flag == "N", "DEGREE").otherwise(
            "TRAINING"
        ).alias("qual_type"),
        F.col("l_shipdate").cast("date").alias("grant_date"),
        F.col("l_suppkey").alias("emp_id"),
    )


def job_execution_log(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    seconds = F.col("value").cast("decimal(18,3)")
    return events.select(
        F.col("event_id").alias("log_id"),
        kind.alias("job_name"),
        F.col("ts").alias("execution_start"),
        F.col("ts").alias("execution_end"),
        F.when(kind == "error", "FAILED").when(kind == "purchase", "WARNING").otherwise(
            "SUCCESS"
        ).alias("status"),
        F.col("user_id").alias("records_affected"),
        F.col("props").alias("error_message"),
        seconds.alias("execution_time_sec"),
    )


def employees(customer: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    department = F.col("c_nationkey").cast("bigint")
    return customer.select(
        key.alias("employee_id"),
        F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("last_name"),
        F.col("c_acctbal").cast(MONEY).alias("salary"),
        F.col("c_mktsegment").alias("job_id"),
        _when_not(department == 24, department).alias("department_id"),
        _when_not(key == 0, F.floor((key - 1) / 10).cast("bigint")).alias("manager_id"),
    )


def departments(nation: DataFrame) -> DataFrame:
    key = F.col("n_nationkey").cast("bigint")
    return nation.select(
        key.alias("department_id"),
        F.col("n_name").alias("department_name"),
        _when_not(key % 9 == 8, key * 5).alias("manager_id"),
        key.alias("location_id"),
    )


def jobs(customer: DataFrame) -> DataFrame:
    segment = F.col("c_mktsegment")
    return customer.select(
        segment.alias("job_id"), F.concat(F.lit("Job "), segment).alias("job_title")
    ).distinct()


def locations(nation: DataFrame) -> DataFrame:
    key = F.col("n_nationkey").cast("bigint")
    return nation.select(
        key.alias("location_id"),
        F.concat(F.lit("City "), F.col("n_name")).alias("city"),
        key.alias("country_id"),
    )


def countries(nation: DataFrame) -> DataFrame:
    return nation.select(
        F.col("n_nationkey").cast("bigint").alias("country_id"),
        F.concat(F.lit("Country "), F.col("n_name")).alias("country_name"),
        F.col("n_regionkey").cast("bigint").alias("region_id"),
    )


def regions(region: DataFrame) -> DataFrame:
    return region.select(
        F.col("r_regionkey").cast("bigint").alias("region_id"), F.col("r_name").alias("region_name")
    )


def company_employee(customer: DataFrame) -> DataFrame:
    return employees(customer).select(
        F.col("employee_id").alias("ssn"),
        F.col("first_name").alias("fname"),
        F.col("last_name").alias("lname"),
        F.col("department_id").alias("dno"),
        F.col("manager_id").alias("super_ssn"),
    )


def company_department(nation: DataFrame) -> DataFrame:
    return nation.select(
        F.col("n_nationkey").cast("bigint").alias("dnum"), F.col("n_name").alias("dname")
    )


def project(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").alias("pnumber"),
        F.col("p_name").alias("pname"),
        (F.col("p_size") % 25).cast("bigint").alias("dno"),
    )


def works_on(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.col("l_suppkey").alias("essn"),
        F.col("l_partkey").alias("pno"),
        F.col("l_quantity").cast("decimal(4,1)").alias("hours"),
    )


def dependent(labels: DataFrame) -> DataFrame:
    return labels.select(
        F.col("doc_id").alias("essn"),
        F.concat(F.lit("Dependent "), F.col("doc_id")).alias("dependent_name"),
        F.when(F.col("toxic") == 0, F.when(F.col("quality") == 1, "Child").otherwise("Spouse")).alias(
            "relationship"
        ),
    )


def authors(supplier: DataFrame) -> DataFrame:
    return supplier.select(
        F.col("s_suppkey").alias("author_id"),
        F.col("s_name").alias("first_name"),
        F.concat(F.lit("Writer "), F.col("s_suppkey")).alias("last_name"),
        F.col("s_nationkey").cast("string").alias("country"),
        (1900 + F.col("s_suppkey") % 100).cast("int").alias("birth_year"),
    )


def books(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").alias("book_id"),
        F.col("p_name").alias("title"),
        F.floor(F.col("p_partkey") / 10).cast("bigint").alias("author_id"),
        F.col("p_retailprice").cast("decimal(8,2)").alias("price"),
        F.col("p_type").alias("genre"),
        (1950 + F.col("p_size")).cast("int").alias("publish_year"),
    )


def book_orders(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("book_id"),
        F.concat(F.lit("Reader "), F.col("o_custkey")).alias("customer_name"),
        (1 + F.col("o_orderkey") % 9).cast("int").alias("quantity"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("total_price"),
    )


# view -> (benchmark table, mapping)
_VIEWS = {
    "employee": ("customer", employee),
    "job_department": ("nation", job_department),
    "salary_bonus": ("part", salary_bonus),
    "payroll": ("orders", payroll),
    "leave": ("events", leave),
    "qualification": ("lineitem", qualification),
    "job_execution_log": ("events", job_execution_log),
    "employees": ("customer", employees),
    "departments": ("nation", departments),
    "jobs": ("customer", jobs),
    "locations": ("nation", locations),
    "countries": ("nation", countries),
    "regions": ("region", regions),
    "company_employee": ("customer", company_employee),
    "company_department": ("nation", company_department),
    "project": ("part", project),
    "works_on": ("lineitem", works_on),
    "dependent": ("labels", dependent),
    "authors": ("supplier", authors),
    "books": ("part", books),
    "book_orders": ("orders", book_orders),
}

# Columns of the benchmark tables; reading with a known schema opens no footers.
_RAW = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": """c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,
        c_mktsegment string""",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": """p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,
        p_retailprice double""",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
        l_quantity double, l_extendedprice double, l_discount double, l_tax double,
        l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz""",
    "events": """event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,
        value double, props string""",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def star_tables(spark: SparkSession, folder: str) -> Tables:
    """All adapter views over one benchmark folder, plus its own tables prefixed ``raw_``."""
    frames = {
        f"raw_{n}": (lambda n=n, schema=schema: load_table(spark, folder, n, schema))
        for n, schema in _RAW.items()
    }
    raw = Tables(**frames)
    views = {
        name: (lambda src=src, view=view: view(raw[f"raw_{src}"]))
        for name, (src, view) in _VIEWS.items()
    }
    tables = Tables(**frames, **views)
    tables.folder = folder
    return tables
