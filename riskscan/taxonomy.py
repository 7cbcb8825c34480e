"""The fixed risk / privacy taxonomy and its views as Spark literals and dimension tables.

Every operator takes an optional ``Taxonomy`` so that a caller can swap in
another set of categories; ``DEFAULT`` holds the standard one.  All the tables
here have a fixed, small size (the largest has 58 risks), which is what makes
it safe to ship them as literals or to broadcast them.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --------------------------------------------------------------------------
# They have to be exactly these for results to agree.
# --------------------------------------------------------------------------

L2_NAMES = {
    "1": "Operating Model & Risk Management",
    "2": "Develop and Acquire Software and Systems",
    "3": "Manage & Demise IT Assets",
    "4": "Manage Data",
    "5": "Protect Data",
    "6": "Identity & Access Management",
    "7": "Manage Infrastructure",
    "8": "Manage IT Vulnerabilities & Patching",
    "9": "Manage Technology Capacity & Resources",
    "10": "Monitor & Respond to Technology Incidents",
    "11": "Monitor and Respond to Security Incidents",
    "12": "Manage Business Continuity and Disaster Recovery",
}

MACRO_RISKS = {
    "1": [
        "Policy/Standard Review",
        "KCI / KRI completeness",
        "IT General & Baseline Controls (Coverage)",
        "Framework Controls (External/Internal)",
        "Exception Management & Risk Tolerance",
        "Issue Management",
        "Monitoring & Testing (MAT)",
        "Security / IT Awareness Training",
        "Maturity Baseline (Yearly)",
        "Governance (Operational Controls)",
    ],
    "2": [
        "Flag Ship Control Coverage",
        "Business Requirement Approval Process",
        "Change Process (Standards & Emergency)",
        "Post Implementation Evaluation (ORE)",
        "Software Dependencies (Internal and External)",
        "M&A – Control Coverage",
    ],
    "3": [
        "Inventory Accuracy & Completeness",
        "Asset Classification & Governance",
        "End of Life – (Hardware and Software)",
        "Asset Destruction (Storage / Media)",
    ],
    "4": [
        "Data Identification, Inventory & Lineage",
        "Data Classification & Governance",
        "Data Quality Controls",
    ],
    "5": [
        "Data Monitoring Processes",
        "Encryption (At Rest, Use, Transit)",
        "Data Loss Prevention",
        "Sensitive Data Logging",
        "Third Party Data Protection",
        "Removable Media",
    ],
    "6": [
        "Authentication",
        "Authorization",
        "Privilege Management",
        "Identity Access Lifecycle (Joiners/Movers/Leavers)",
        "Segregation of Duties",
        "Secrets Management",
        "Production Access",
    ],
    "7": [
        "Configuration Management",
        "Network Segmentation",
        "Cloud Controls",
        "Data Center Management",
    ],
    "8": [
        "Scanning Completeness",
        "Patching Completeness",
        "S-SDLC drafts",
        "Vulnerability assessment and risk treatment",
    ],
    "9": [
        "Capacity Planning",
        "SLO Management",
        "Monitoring (Availability, Performance and Latency)",
    ],
    "10": [
        "Incident Identification & Classification",
        "Tech Incident Reporting & Escalation",
        "Thematic & Trends",
    ],
    "11": [
        "Incident Response Planning",
        "Incident Monitoring and Handling",
        "Security Incident Reporting & Escalation",
        "Audit Logging / Post Mortem",
        "Incident Response Testing",
        "Threat Intelligence",
    ],
    "12": [
        "Operational Resiliency",
        "Cyber Resilience",
    ],
}

# There is no PC2.
PROTECTION_CATEGORIES = {
    "PC0": "Public information with no confidentiality requirements",
    "PC1": "Internal information with basic confidentiality requirements",
    "PC3": "Confidential information with high protection requirements",
}

PII_TYPES = [
    "Name", "Email", "Phone", "Address", "SSN", "Financial", "Health",
    "Credentials", "Biometric", "National ID", "DOB", "Gender",
    "Location", "IP Address", "Device ID", "Customer ID", "Employment",
]

PRIVACY_LABELS = {"PC0": "Public", "PC1": "Internal", "PC3": "Confidential"}

SENSITIVITY_LABELS = {"DP10": "Public", "DP20": "Restricted", "DP30": "Highly Restricted"}

RISK_KEYWORDS = {
    "1": ["policy", "standard", "governance", "framework", "control", "baseline", "training", "awareness",
          "maturity", "monitoring", "testing", "kci", "kri", "exception", "tolerance", "issue management"],
    "2": ["development", "acquire", "software", "change", "requirement", "implementation", "dependency",
          "m&a", "sdlc", "deployment"],
    "3": ["inventory", "asset", "classification", "end of life", "destruction", "hardware", "media", "disposal"],
    "4": ["data identification", "lineage", "data classification", "data governance", "data quality", "metadata"],
    "5": ["encryption", "data loss", "dlp", "logging", "third party", "removable media", "data protection",
          "at rest", "in transit"],
    "6": ["authentication", "authorization", "privilege", "access", "identity", "joiner", "mover", "leaver",
          "segregation", "duties", "secrets", "production"],
    "7": ["configuration", "network", "segmentation", "cloud", "data center", "infrastructure"],
    "8": ["vulnerability", "patching", "scanning", "assessment", "s-sdlc", "security testing"],
    "9": ["capacity", "planning", "slo", "availability", "performance", "latency", "monitoring"],
    "10": ["incident", "identification", "classification", "escalation", "trend", "technical"],
    "11": ["security incident", "incident response", "monitoring", "handling", "audit", "post mortem",
           "threat intelligence"],
    "12": ["resilience", "continuity", "disaster", "recovery", "cyber resilience", "operational"],
}

PII_KEYWORDS = {
    "PC0": ["public", "marketing", "documentation", "open data", "website", "brochure"],
    "PC1": ["name", "contact", "business email", "job title", "company", "department", "customer id"],
    "PC3": ["ssn", "social security", "financial", "bank", "credit card", "health", "medical", "password",
            "credential", "biometric", "national id", "driver license", "passport"],
}


@dataclass(frozen=True)
class Taxonomy:
    """One consistent set of categories; dict order is priority order everywhere."""

    l2: dict[str, str] = field(default_factory=lambda: dict(L2_NAMES))
    macro_risks: dict[str, list[str]] = field(default_factory=lambda: {k: list(v) for k, v in MACRO_RISKS.items()})
    protection: dict[str, str] = field(default_factory=lambda: dict(PROTECTION_CATEGORIES))
    pii_types: list[str] = field(default_factory=lambda: list(PII_TYPES))
    privacy_labels: dict[str, str] = field(default_factory=lambda: dict(PRIVACY_LABELS))
    sensitivity_labels: dict[str, str] = field(default_factory=lambda: dict(SENSITIVITY_LABELS))
    risk_keywords: dict[str, list[str]] = field(default_factory=lambda: {k: list(v) for k, v in RISK_KEYWORDS.items()})
    pii_keywords: dict[str, list[str]] = field(default_factory=lambda: {k: list(v) for k, v in PII_KEYWORDS.items()})

    # ---- plain views -----------------------------------------------------

    @property
    def l2_labels(self) -> list[str]:
        return [f"{key}. {name}" for key, name in self.l2.items()]

    @property
    def all_risks(self) -> list[str]:
        return [risk for risks in self.macro_risks.values() for risk in risks]

    # ---- literal columns -------------------------------------------------

    def risks_of(self, l2_key: Column) -> Column:
        """array<string> of the risks of one L2 key; null for an unknown key."""
        return F.element_at(literal(self.macro_risks, "map<string,array<string>>"), l2_key)

    # ---- dimension tables (S10) -------------------------------------------

    def l2_dim(self, spark: SparkSession) -> DataFrame:
        rows = [(key, pos, name) for pos, (key, name) in enumerate(self.l2.items())]
        return spark.createDataFrame(rows, "l2_key string, l2_ord int, l2_name string")

    def macro_risk_dim(self, spark: SparkSession) -> DataFrame:
        rows = [(key, pos, risk) for key, risks in self.macro_risks.items() for pos, risk in enumerate(risks)]
        return spark.createDataFrame(rows, "l2_key string, risk_ord int, risk string")

    def pc_dim(self, spark: SparkSession) -> DataFrame:
        rows = [(pc, text, self.privacy_labels.get(pc), rank)
                for rank, (pc, text) in enumerate(self.protection.items())]
        return spark.createDataFrame(rows, "pc_category string, description string, privacy_label string, rank int")

    def pii_type_dim(self, spark: SparkSession) -> DataFrame:
        rows = [(name, pos) for pos, name in enumerate(self.pii_types)]
        return spark.createDataFrame(rows, "pii_type string, ord int")

    def sensitivity_dim(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.sensitivity_labels.items()), "dp string, sensitivity_label string")

    def risk_keyword_dim(self, spark: SparkSession) -> DataFrame:
        rows = [(key, phrase) for key, phrases in self.risk_keywords.items() for phrase in phrases]
        return spark.createDataFrame(rows, "l2_key string, phrase string")

    def pii_keyword_dim(self, spark: SparkSession) -> DataFrame:
        rows = [(pc, phrase) for pc, phrases in self.pii_keywords.items() for phrase in phrases]
        return spark.createDataFrame(rows, "pc_category string, phrase string")


DEFAULT = Taxonomy()


def literal(value, ddl_type: str) -> Column:
    """A nested constant as one expression; the optimizer folds it into a literal, so
    plans stay small and nothing is parsed per row."""
    return F.from_json(F.lit(json.dumps(value, ensure_ascii=False)), ddl_type)


def str_array(values: list[str]) -> Column:
    """Literal array<string>."""
    return literal(list(values), "array<string>")
