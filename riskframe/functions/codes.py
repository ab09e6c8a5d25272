"""Hierarchical code categorizer (P15) as a native expression.

A code is: null / 'unknown' / '?' -> Unknown; 'V...' and 'E...' prefixes;
otherwise the integer part (text before the first '.') parsed as a number and
placed in a range table; unparsable -> Unknown; outside every range -> the
fallback label. The range table is data: a caller may pass another one.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values --------------------------------------------------------------
# ICD-9 chapter ranges (inclusive) and labels, as the reference reports them.
ICD9_RANGES = [
    (1, 139, "Infecciosas/Parasitárias"),
    (140, 239, "Neoplasias"),
    (240, 279, "Endócrinas/Metabólicas"),
    (280, 289, "Sangue/Órgãos Hematopoiéticos"),
    (290, 319, "Mentais"),
    (320, 389, "Sistema Nervoso"),
    (390, 459, "Circulatórias"),
    (460, 519, "Respiratórias"),
    (520, 579, "Digestivas"),
    (580, 629, "Genitourinárias"),
    (630, 679, "Gravidez/Parto"),
    (680, 709, "Pele/Subcutâneo"),
    (710, 739, "Musculoesqueléticas"),
    (740, 759, "Congênitas"),
    (760, 779, "Perinatais"),
    (780, 799, "Sintomas/Sinais"),
    (800, 999, "Lesões/Envenenamentos"),
]
V_LABEL = "V-Codes (Suplementar)"
E_LABEL = "E-Codes (Externa)"
UNKNOWN_LABEL = "Unknown"
OTHER_LABEL = "Outros"
UNKNOWN_TOKENS = ["unknown", "?"]
# --------------------------------------------------------------------------------


def categorize_code(c: Column, ranges=ICD9_RANGES, other: str = OTHER_LABEL) -> Column:
    s = F.trim(c)
    num = F.split(s, r"\.").getItem(0).try_cast("double")
    expr = F.when(c.isNull() | c.isin(UNKNOWN_TOKENS), F.lit(UNKNOWN_LABEL)) \
        .when(s.startswith("V"), F.lit(V_LABEL)).when(s.startswith("E"), F.lit(E_LABEL)) \
        .when(num.isNull(), F.lit(UNKNOWN_LABEL))
    for lo, hi, label in ranges:
        expr = expr.when((num >= lo) & (num <= hi), F.lit(label))
    return expr.otherwise(F.lit(other))


def categorize_code_sql(col: str, ranges=ICD9_RANGES, other: str = OTHER_LABEL) -> str:
    num = f"TRY_CAST(split_part(trim({col}), '.', 1) AS DOUBLE)"
    toks = ", ".join(f"'{t}'" for t in UNKNOWN_TOKENS)
    parts = [f"WHEN {col} IS NULL OR {col} IN ({toks}) THEN '{UNKNOWN_LABEL}'",
             f"WHEN starts_with(trim({col}), 'V') THEN '{V_LABEL}'",
             f"WHEN starts_with(trim({col}), 'E') THEN '{E_LABEL}'",
             f"WHEN {num} IS NULL THEN '{UNKNOWN_LABEL}'"]
    parts += [f"WHEN {num} >= {lo} AND {num} <= {hi} THEN '{label}'" for lo, hi, label in ranges]
    return f"(CASE {' '.join(parts)} ELSE '{other}' END)"
