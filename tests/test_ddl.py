from pyspark.sql import functions as F

from riskscan.functions import ddl as rules
from riskscan.operators import ddl as dd

CASES = [
    "CREATE TABLE people (person_id INT PRIMARY KEY, first_name VARCHAR(50) NOT NULL, ssn CHAR(11), pay DECIMAL(10, 2), id_number INT)",
    "CREATE TABLE goods (product_id INT, product_name VARCHAR(255), status ENUM('a', 'b'), price DECIMAL(8,2))",
    "CREATE TABLE only (id INT)",
    "CREATE TABLE IF NOT EXISTS s.t (keyword TEXT, q LONGTEXT, x VARCHAR(11))",
    "CREATE TABLE `a b` (x INT)",
    "nothing",
]


def _analyzed(spark):
    df = spark.createDataFrame(list(enumerate(CASES)), "stmt_id int, ddl string")
    return dd.analyze_ddl(df).orderBy("stmt_id").collect()


def test_statements(spark):
    rows = _analyzed(spark)
    assert [r["overall_classification"] for r in rows] == ["PC3", "PC1", "AMBIGUOUS", "PC0", "PC0", "PC0"]
    assert [r["table_name"] for r in rows] == ["people", "goods", "only", "IF", "unknown_table", "unknown_table"]
    first = {c["column_name"]: c for c in rows[0]["columns"]}
    assert first["ssn"]["pii_types"] == ["SSN"] and first["pay"]["data_type"] == "DECIMAL(10,"
    assert first["id_number"]["ambiguous_type"] == "number" and len(first["id_number"]["reasoning"]) == 2
    assert rows[0]["compliance_flags"] == ["REQUIRES_GDPR_REVIEW", "REQUIRES_CCPA_REVIEW", "REQUIRES_DPO_APPROVAL"]
    assert rows[2]["pii_summary"]["AMBIGUOUS"] == ["Ambiguous_id", "Ambiguous_id"]
    assert rows[2]["compliance_flags"] == ["REQUIRES_HUMAN_REVIEW", "REQUIRES_PRIVACY_OFFICER_REVIEW"]
    assert [c["column_name"] for c in rows[3]["columns"]] == ["q", "x"]
    assert rows[3]["columns"][1]["pii_types"] == ["SSN"] and len(rows[3]["columns"][1]["reasoning"]) == 2
    assert rows[5]["columns"] == []


def test_column_lines_equal_a_character_walk(spark):
    import random

    rng = random.Random(3)
    bodies = ["".join(rng.choice("ab ,,(()) \n") for _ in range(rng.randint(0, 30))) for _ in range(200)]
    df = spark.createDataFrame([("(" + b + ")",) for b in bodies], "ddl string")
    for row in df.select("ddl", rules.column_lines(F.col("ddl")).alias("lines")).collect():
        lines, line, depth = [], "", 0
        for ch in row["ddl"][1:-1]:
            if ch == "," and depth == 0:
                lines.append(line.strip())
                line = ""
                continue
            depth += (ch == "(") - (ch == ")")
            line += ch
        lines.append(line.strip())
        assert row["lines"] == [x for x in lines if x]


def test_catalog_agrees_with_statements(spark):
    df = spark.createDataFrame(list(enumerate(CASES[:4])), "stmt_id int, ddl string")
    report = dd.catalog_report(dd.classify_columns(dd.explode_columns(df)), "stmt_id")
    by_id = {r["stmt_id"]: r for r in report.collect()}
    for row in _analyzed(spark)[:4]:
        assert by_id[row["stmt_id"]]["overall_classification"] == row["overall_classification"]
        assert by_id[row["stmt_id"]]["compliance_flags"] == row["compliance_flags"]


def test_the_class_alone_makes_no_findings(spark):
    """D10 needs a few bits a column: no reasoning, explanations or types."""
    df = spark.createDataFrame([(1, "CREATE TABLE t (ssn INT, title TEXT)"), (2, None)], "stmt_id int, ddl string")
    analyzed = dd.analyze_ddl(df)
    assert [tuple(r) for r in analyzed.select("overall_classification", "requires_human_review", "compliance_flags").collect()] == [
        ("PC3", True, ["REQUIRES_GDPR_REVIEW", "REQUIRES_CCPA_REVIEW", "REQUIRES_DPO_APPROVAL"]), ("PC0", False, []),
    ]
    plan = analyzed.select("stmt_id", "overall_classification")._jdf.queryExecution().optimizedPlan().toString()
    assert "Check if related" not in plan and "suggests" not in plan and "VARCHAR(255)" not in plan
