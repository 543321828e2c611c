"""The entity schema and the label taxonomy every operator shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ENTITY = "seq BIGINT, text STRING, label STRING, start INT, end INT, source STRING, confidence DOUBLE, generalized STRING, risk STRING"
ENTITY_TYPE = f"STRUCT<{', '.join(f.replace(' ', ': ', 1) for f in ENTITY.split(', '))}>"

# Placeholder of each label.
PLACEHOLDERS = {
    "private_person": "[PERSON]",
    "private_email": "[E-POST]",
    "private_phone": "[TELEFON]",
    "private_address": "[ADRESS]",
    "account_number": "[ID-NUMMER]",
    "private_date": "[DATUM]",
    "secret": "[HEMLIG-UPPGIFT]",
    "demographics": "[DEMOGRAFISK-UPPGIFT]",
    "medical": "[MEDICINSK-UPPGIFT]",
    "temporal": "[TIDPUNKT]",
    "social": "[SOCIAL-UPPGIFT]",
    "private_vehicle": "[FORDON]",
    "private_device": "[ENHET]",
    "private_url": "[URL]",
    "private_ip": "[IP-ADRESS]",
    "private_biometric": "[BIOMETRISK-UPPGIFT]",
    "private_photo": "[FOTOGRAFI]",
    "private_other": "[ÖVRIG-UPPGIFT]",
    "age": "[ÅLDER]",
}
# Placeholder of unknown labels.
FALLBACK = "[REDAKTERAD]"
# Labels that are direct identifiers whatever else is said of them.
DIRECT = (
    "private_person", "private_email", "private_phone", "account_number", "private_date", "secret", "private_vehicle",
    "private_device", "private_url", "private_ip", "private_biometric", "private_photo", "private_other",
)
# Labels protected where ground truth found them, labels kept as they stand, sources of ground truth, all sources.
PROTECTED = (*DIRECT, "private_address")
VERBATIM = ("medication",)
GROUND_TRUTH = ("rule", "bert", "gazetteer")
SOURCES = ("rule", "bert", "gazetteer", "llm", "propagated")
# Confidence of each detector.
CONFIDENCE = {"rule": 1.0, "bert": 0.95, "gazetteer": 0.9, "llm": 0.8}


def sql_list(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def taxonomy(spark: SparkSession) -> DataFrame:
    """One row a label: placeholder and class flags (20 rows, safe to broadcast)."""
    rows = [(k, v, k in DIRECT, k in PROTECTED, False) for k, v in PLACEHOLDERS.items()]
    rows += [(k, None, False, False, True) for k in VERBATIM]
    return spark.createDataFrame(rows, "label STRING, placeholder STRING, direct BOOLEAN, protected BOOLEAN, verbatim BOOLEAN")


def placeholder_of(label: Column) -> Column:
    """The placeholder of a label as a literal map lookup; the fallback for labels unknown."""
    pairs = F.create_map(*[F.lit(x) for kv in PLACEHOLDERS.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, F.coalesce(label, F.lit(""))), F.lit(FALLBACK))


def is_direct(label: Column) -> Column:
    return F.coalesce(label.isin(*DIRECT), F.lit(False))
