"""Names and types shared by the batch and streaming paths.

Every operator takes label, key and feature names as parameters; the lists
below are only the defaults for machine-reading tables.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: must equal the source application's for compatible models
# and messages. The 72 machine readings in the order the saved assembler
# expects them (order matters: a fitted VectorAssembler stores it).
FEATURES: list[str] = [
    "tmpMoldZone25", "timCool1", "tmpBarrel2Zone3", "tmpMoldZone3", "tmpBarrel2Zone4",
    "tmpFlange1", "tmpMoldZone4", "tmpBarrel2Zone1", "tmpFlange2", "tmpMoldZone1",
    "volCushion1", "tmpBarrel2Zone2", "tmpMoldZone2", "volCushion2", "prsBackSpec2",
    "prsBackSpec1", "tmpMoldZone9", "spdInjection2", "tmpMoldZone7", "tmpMoldZone8",
    "tmpOil", "tmpMoldZone5", "tmpMoldZone6", "tmpMoldZone19", "tmpMoldZone18",
    "volTransfer2", "tmpMoldZone15", "volTransfer1", "tmpMoldZone14", "tmpMoldZone17",
    "tmpMoldZone16", "timTransfer2", "timTransfer1", "velPlasticisation2",
    "velPlasticisation1", "timMoldClose", "tmpBarrel1Zone5", "tmpMoldZone22",
    "tmpBarrel1Zone4", "tmpMoldZone21", "tmpMoldZone24", "tmpBarrel1Zone6",
    "tmpMoldZone23", "prsPomp1", "tmpBarrel1Zone1", "prsPomp2", "tmpBarrel1Zone3",
    "tmpMoldZone20", "tmpBarrel1Zone2", "volShot1", "volPlasticisation2", "volShot2",
    "volPlasticisation1", "timFill1", "timFill2", "timMoldOpen", "tmpMoldZone11",
    "tmpMoldZone10", "tmpMoldZone13", "tmpMoldZone12", "prsHoldSpec2", "tmpNozle2",
    "prsHoldSpec1", "tmpNozle1", "prsTransferSpec2", "prsTransferSpec1",
    "prsInjectionSpec1", "prsInjectionSpec2", "timCycle", "frcClamp",
    "timPlasticisation1", "timPlasticisation2",
]
# Label column and its meaning: 0 = good part ("OK"), 1 = defective ("NOK").
LABEL = "reason"
CLASS_NAMES = {0: "OK", 1: "NOK"}
# Raw label text that marks a good part; any other text (or none) is a defect.
GOOD_REASON_TEXT = "[]"
# Columns of the raw machine export that are not model inputs.
RAW_DROP = [
    "Unnamed: 0", "date", "cntCycle", "stsMachine", "timestamp", "sfc", "decMold",
    "prsInjectionHyd1", "prsTransferHyd1", "strCushion1", "strPlasticisation1",
    "strTransfer1",
]
RAW_DROP_EXTRA = ["spdInjection1"]
# Cycle time is the message key of the alert output.
CYCLE_TIME = "timCycle"
# Class cut-offs of the production forest (index = class).
PRODUCTION_THRESHOLDS = [0.18, 0.82]
# --- end of fixed values


def message_schema(fields: list[str] | None = None, label: str | None = LABEL) -> T.StructType:
    """Schema of one JSON message: the label (if any) then the fields, all double."""
    names = ([label] if label else []) + list(fields if fields is not None else FEATURES)
    return T.StructType([T.StructField(n, T.DoubleType(), True) for n in names])


def csv_schema(features: list[str] | None = None, label: str = LABEL,
               index_col: str | None = "_c0") -> T.StructType:
    """Explicit schema of the prepared CSV (index, label, features), so the scan
    needs no inference pass."""
    fields = []
    if index_col:
        fields.append(T.StructField(index_col, T.LongType(), True))
    fields.append(T.StructField(label, T.IntegerType(), True))
    fields += [T.StructField(n, T.DoubleType(), True) for n in (features or FEATURES)]
    return T.StructType(fields)
