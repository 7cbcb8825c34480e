"""Tables the queries derive from the given ones, in SQL that both engines run.

The given tables hold few findings, schemas or model responses, so these views
turn their rows into such records.  They have one row per source row and grow
with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskscan.plans.registry import plain_sql, spark_sql

PII_TEMPLATE = """
SELECT @key AS id,
  CASE @key % 9
    WHEN 0 THEN 'Customer record: ' || @label || ', SSN: ' || lpad(CAST(@key % 900 + 100 AS STRING), 3, '0') || '-45-' || lpad(CAST(@key % 10000 AS STRING), 4, '0')
    WHEN 1 THEN 'Contact ' || lower(@word) || CAST(@key AS STRING) || '@mail.example.com'
    WHEN 2 THEN 'Call 555-123-' || lpad(CAST(@key % 10000 AS STRING), 4, '0') || ' about the account'
    WHEN 3 THEN 'Born 19' || lpad(CAST(@key % 100 AS STRING), 2, '0') || '-0' || CAST(@key % 9 + 1 AS STRING) || '-1' || CAST(@key % 10 AS STRING)
    WHEN 4 THEN CAST(@key % 900 + 1 AS STRING) || ' Harbor View Street, access control audit'
    WHEN 5 THEN 'Vulnerability and encryption risk in ' || @word
    WHEN 6 THEN 'Public marketing brochure'
    WHEN 7 THEN 'Health plan and passport number for employee ' || CAST(@key AS STRING)
    ELSE '   ' END AS text
FROM $@table
"""


def _pii(key: str, label: str, word: str, source: str) -> str:
    text = PII_TEMPLATE
    for mark, value in (("@key", key), ("@label", label), ("@word", word), ("@table", source)):
        text = text.replace(mark, value)
    return text


FIXTURES: dict[str, tuple[str, list[str]]] = {
    "pii_fx": (_pii("c_custkey", "c_name", "c_mktsegment", "customer"), ["customer"]),
    "pii_lines_fx": (_pii("l_orderkey", "CAST(l_partkey AS STRING)", "l_returnflag", "lineitem"), ["lineitem"]),
    "findings_fx": (
        """
SELECT o_orderkey AS id,
  CASE o_orderkey % 5 WHEN 0 THEN 'Weak   authentication (  ) on admin portal' WHEN 1 THEN '##' WHEN 2 THEN '12345'
    WHEN 3 THEN 'Disk encryption missing [prod]' ELSE CAST(NULL AS STRING) END AS Title,
  CASE o_orderkey % 4 WHEN 0 THEN 'Order desk ' || o_orderpriority || ' lacks network segmentation' WHEN 1 THEN ''
    WHEN 2 THEN 'Backups were never tested for operational resiliency' ELSE CAST(NULL AS STRING) END AS Description,
  CASE o_orderkey % 7 WHEN 0 THEN '5. Protect Data' WHEN 1 THEN 'identity & access management' WHEN 2 THEN '7'
    WHEN 3 THEN 'Manage Data' WHEN 4 THEN 'no such label zzz' WHEN 5 THEN '' ELSE CAST(NULL AS STRING) END AS L2,
  CASE o_orderkey % 6 WHEN 0 THEN 'Authentication, Authorization' WHEN 1 THEN 'Network Segmentation;Cloud Controls'
    WHEN 2 THEN 'Data Loss Prevention' WHEN 3 THEN 'Capacity Planning|SLO Management'
    WHEN 4 THEN 'Encryption (At Rest, Use, Transit)' ELSE CAST(NULL AS STRING) END AS Risks,
  CASE o_orderkey % 11 WHEN 0 THEN 'reported by desk ' || o_orderstatus ELSE CAST(NULL AS STRING) END AS Origin
FROM $orders
""",
        ["orders"],
    ),
    "labels_fx": (
        """
SELECT o_orderkey AS id,
  CASE o_orderkey % 13 WHEN 0 THEN 'Protect the data' WHEN 1 THEN 'IT vulnerabilities' WHEN 2 THEN 'acess managment'
    WHEN 3 THEN 'Respond to security incident' WHEN 4 THEN 'disaster recovery' WHEN 5 THEN '12 continuity'
    WHEN 6 THEN 'Operating Model' WHEN 7 THEN 'infrastructure' WHEN 8 THEN 'qqq' WHEN 9 THEN '6: identity'
    WHEN 10 THEN 'Manage  Data' WHEN 11 THEN 'capacity & resources' ELSE o_orderpriority END AS l2_label,
  CASE o_orderkey % 11 WHEN 0 THEN 'authentification' WHEN 1 THEN 'data loss' WHEN 2 THEN 'segregation of duty'
    WHEN 3 THEN 'patching' WHEN 4 THEN 'cloud control' WHEN 5 THEN 'incident response' WHEN 6 THEN 'removable media'
    WHEN 7 THEN 'zzz' WHEN 8 THEN 'Secrets' WHEN 9 THEN 'Third-party protection' ELSE o_orderpriority END AS risk_label
FROM $orders
""",
        ["orders"],
    ),
    "claims_fx": (
        """
SELECT o_orderkey AS id,
  CASE o_orderkey % 5 WHEN 0 THEN '6. Identity & Access Management' WHEN 1 THEN '1. Operating Model & Risk Management'
    WHEN 2 THEN '99. Unknown' WHEN 3 THEN CAST(NULL AS STRING) ELSE '11. Monitor and Respond to Security Incidents' END AS l2_category,
  CASE o_orderkey % 7 WHEN 0 THEN 'authentication' WHEN 1 THEN 'Secrets' WHEN 2 THEN 'Incident Response'
    WHEN 3 THEN 'Access' WHEN 4 THEN 'issue management board' WHEN 5 THEN 'handling incident monitoring' ELSE 'duties' END AS risk_a,
  CASE o_orderkey % 8 WHEN 0 THEN 'Privilege Management' WHEN 1 THEN 'KRI' WHEN 2 THEN 'completeness kri / kci'
    WHEN 3 THEN 'security incident reporting' WHEN 4 THEN 'Production Access Production' WHEN 5 THEN 'testing response incident'
    WHEN 6 THEN 'Audit' ELSE o_orderpriority END AS risk_b
FROM $orders
""",
        ["orders"],
    ),
    "ddl_fx": (
        """
SELECT p_partkey AS stmt_id,
  CASE p_partkey % 10
    WHEN 0 THEN 'CREATE TABLE customers_' || CAST(p_partkey AS STRING) || ' (customer_id INT PRIMARY KEY, first_name VARCHAR(50) NOT NULL, ssn CHAR(11), balance DECIMAL(10,2));'
    WHEN 1 THEN 'create table staff (emp_id INT, salary DECIMAL(10, 2), work_email VARCHAR(255), PRIMARY KEY (emp_id))'
    WHEN 2 THEN 'CREATE TABLE products (product_id INT, price DECIMAL(8,2), status ENUM(' || chr(39) || 'a' || chr(39) || ',' || chr(39) || 'b' || chr(39) || '))'
    WHEN 3 THEN 'CREATE TABLE misc (id INT, ref_no INT, id_number INT, keyword TEXT, q LONGTEXT)'
    WHEN 4 THEN 'CREATE TABLE IF NOT EXISTS s.visits (patient_id INT, diagnosis TEXT)'
    WHEN 5 THEN 'ALTER TABLE ' || chr(34) || 'users' || chr(34) || ' ADD COLUMN pwd VARCHAR(64)'
    WHEN 6 THEN 'CREATE VIEW v AS SELECT 1'
    WHEN 7 THEN 'CREATE  TABLE t' || chr(10) || ' (x VARCHAR(10), y VARCHAR(11), UNIQUE (x))'
    WHEN 8 THEN 'CREATE TABLE only_ids (id INT, CHECK (id > (1 + (2))), code CHAR(2))'
    ELSE '  CREATE TABLE `' || lower(p_type) || '` (`' || replace(p_name, ' ', '_') || '_title` VARCHAR(100), size INT DEFAULT 1,, contact_number CHAR(12), voice_print BLOB(1,(2,3)) , solo)' END AS ddl
FROM $part
""",
        ["part"],
    ),
    "responses_fx": (
        """
SELECT event_id AS id,
  CASE WHEN event_id % 2 = 0 THEN 'risk' ELSE 'pii' END AS type,
  'User ' || CAST(user_id AS STRING) || ' bank account event ' || event_type AS text,
  CASE event_id % 24
    WHEN 0 THEN '{"l2_category": "6. Identity & Access Management", "macro_risks": ["authentication", "Secrets", "Nope"]}'
    WHEN 1 THEN '{"pc_category": "PC1", "pii_types": ["SSN", "Work Email"]}'
    WHEN 2 THEN 'Sure: {"l2_category": "99. Unknown", "macro_risks": ["Authentication"]} done'
    WHEN 3 THEN '{"pc_category": "PC2", "pii_types": []}'
    WHEN 4 THEN '{"l2_category": {"k": 1}, "macro_risks": []}'
    WHEN 5 THEN 'Category: PC1. Contains email and phone'
    WHEN 6 THEN 'L2 category: 5. Protect Data' || chr(10) || 'Macro risks: [Data Loss Prevention, Removable Media]'
    WHEN 7 THEN '   '
    WHEN 8 THEN ''
    WHEN 9 THEN '{' || chr(39) || 'pc_category' || chr(39) || ': 1}'
    WHEN 10 THEN '{"l2_category": null, "macro_risks": ["Anything"]}'
    WHEN 11 THEN '{"pc_category": "PC0", "pii_types": ["name"]}'
    WHEN 12 THEN '{"l2_category": "6. Identity & Access Management", "macro_risks": ["Authentication", "Authorization", "Privilege Management", "Segregation of Duties", "Secrets Management", "Production Access"]}'
    WHEN 13 THEN 'The protection level is not clear, it includes a passport' || chr(10) || '- Email address, phone' || chr(10) || 'types: [name, "dob"]'
    WHEN 14 THEN '{"l2_category": "5. Protect Data", "macro_risks": null}'
    WHEN 15 THEN '{"pc_category": "PC3", "pii_types": null}'
    WHEN 16 THEN '8. Manage IT Vulnerabilities & Patching' || chr(10) || '- Patching completeness, scanning' || chr(10) || '- Vulnerability assessment'
    WHEN 17 THEN '{"pc_category": "PC0", "pii_types": ["Home Address", "IP Address", "work email", "work email"]}'
    WHEN 18 THEN 'Issues: weak passwords and ' || event_type || ' abuse. Involving Data Loss Prevention'
    WHEN 19 THEN 'Classification pc_category: "pc3" with types: credit card number, ' || event_type
    WHEN 20 THEN '{"l2_category": 7, "macro_risks": ["Cloud Controls"]}'
    WHEN 21 THEN '{"other": 1}'
    WHEN 22 THEN '{"macro_risks": ["' || event_type || '", "b", "c", "d", "e", "f"]}'
    ELSE 'contains ' || event_type || ' and mobile numbers' END AS response
FROM $events
""",
        ["events"],
    ),
    "privacy_fx": (
        """
SELECT c_custkey AS id,
  'COL_' || CAST(n_nationkey AS STRING) AS COLUMNNAME,
  CASE c_custkey % 7 WHEN 0 THEN 'Email' WHEN 1 THEN 'SSN' WHEN 2 THEN 'Date of birth' WHEN 3 THEN 'Unmapped qqq'
    WHEN 4 THEN 'Phone number' WHEN 5 THEN CAST(NULL AS STRING) ELSE 'ip adress' END AS PRIVACYTYPE,
  CASE c_custkey % 3 WHEN 0 THEN 'Email' WHEN 1 THEN CAST(NULL AS STRING) ELSE 'Customer ID' END AS PRIVACYTYPENAME,
  CASE c_custkey % 4 WHEN 0 THEN 'DP10 Public' WHEN 1 THEN 'DP20 Restricted' WHEN 2 THEN 'DP30 Highly Restricted'
    ELSE CAST(NULL AS STRING) END AS PRIVACYTYPECLASSIFICATION,
  CASE c_custkey % 5 WHEN 0 THEN 'device and location of ' || lower(c_mktsegment) WHEN 1 THEN 'financial health'
    ELSE CAST(NULL AS STRING) END AS PRIVACYTYPEDESCRIPTION,
  CASE c_custkey % 6 WHEN 0 THEN CAST(NULL AS STRING) ELSE c_name END AS ENTITYNAME
FROM $customer JOIN $nation ON c_nationkey = n_nationkey
""",
        ["customer", "nation"],
    ),
}


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text, sources = FIXTURES[name]
    return spark_sql(spark, sf_dir, text, sources)


def fixture_sql(name: str) -> str:
    text, sources = FIXTURES[name]
    return f"({plain_sql(text, sources).strip()})"
