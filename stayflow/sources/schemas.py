"""Declared schemas of the clinical tables (the registry every scan uses).

Schemas are never inferred: inference turns an all-digit code such as ``"0389"``
into the integer 389 and breaks every prefix rule downstream.  Each table carries
its primary key and foreign keys so the quality checks in
:mod:`stayflow.operators.quality` can be driven from the registry.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import DoubleType, IntegerType, LongType, ShortType, StringType, StructType, TimestampType


@dataclass(frozen=True)
class TableSpec:
    name: str
    ddl: str
    primary_key: tuple[str, ...] = ()
    # (child columns, parent table, parent columns)
    foreign_keys: tuple[tuple[tuple[str, ...], str, tuple[str, ...]], ...] = ()
    # optional range layout used by ``range_partitioned_layout``
    notes: str = field(default="", compare=False)

    def schema(self) -> StructType:
        """Needs no session: the declared types are all simple."""
        kinds = {"INT": IntegerType(), "BIGINT": LongType(), "SMALLINT": ShortType(), "STRING": StringType(),
                 "DOUBLE": DoubleType(), "TIMESTAMP": TimestampType()}
        out = StructType()
        for column in self.ddl.split(", "):
            name, kind, *rest = column.split(" ")
            out.add(name, kinds[kind], nullable=not rest)
        return out

    def _fields(self) -> list[tuple[str, str, bool]]:
        # (name, type, nullable) read from the DDL text (no session needed)
        out = []
        for part in self.ddl.split(","):
            words = part.split()
            out.append((words[0], words[1], not part.upper().rstrip().endswith("NOT NULL")))
        return out

    def columns(self) -> list[str]:
        return [n for n, _, _ in self._fields()]

    def not_null_columns(self) -> list[str]:
        return [n for n, _, nullable in self._fields() if not nullable]


def _fk(cols, parent, parent_cols=None):
    cols = (cols,) if isinstance(cols, str) else tuple(cols)
    parent_cols = cols if parent_cols is None else ((parent_cols,) if isinstance(parent_cols, str) else tuple(parent_cols))
    return (cols, parent, parent_cols)


# Column names, types and nullability of the MIMIC-III tables as declared
# in the reference's PostgreSQL DDL (names upper-cased as in the CSV headers); row ids are
# BIGINT, as event tables can pass 2 ** 31 rows.
TABLES: dict[str, TableSpec] = {
    "PATIENTS": TableSpec(
        "PATIENTS",
        "ROW_ID BIGINT NOT NULL, SUBJECT_ID INT NOT NULL, GENDER STRING NOT NULL, DOB TIMESTAMP NOT NULL, "
        "DOD TIMESTAMP, DOD_HOSP TIMESTAMP, DOD_SSN TIMESTAMP, EXPIRE_FLAG STRING NOT NULL",
        ("SUBJECT_ID",),
    ),
    "ADMISSIONS": TableSpec(
        "ADMISSIONS",
        "ROW_ID BIGINT NOT NULL, SUBJECT_ID INT NOT NULL, HADM_ID INT NOT NULL, ADMITTIME TIMESTAMP NOT NULL, "
        "DISCHTIME TIMESTAMP, DEATHTIME TIMESTAMP, ADMISSION_TYPE STRING NOT NULL, "
        "ADMISSION_LOCATION STRING NOT NULL, DISCHARGE_LOCATION STRING, INSURANCE STRING NOT NULL, "
        "LANGUAGE STRING, RELIGION STRING, MARITAL_STATUS STRING, ETHNICITY STRING NOT NULL, "
        "EDREGTIME TIMESTAMP, EDOUTTIME TIMESTAMP, DIAGNOSIS STRING, HOSPITAL_EXPIRE_FLAG SMALLINT, "
        "HAS_CHARTEVENTS_DATA SMALLINT",
        ("HADM_ID",),
        (_fk("SUBJECT_ID", "PATIENTS"),),
    ),
    "ICUSTAYS": TableSpec(
        "ICUSTAYS",
        "ROW_ID BIGINT NOT NULL, SUBJECT_ID INT NOT NULL, HADM_ID INT NOT NULL, ICUSTAY_ID INT NOT NULL, "
        "DBSOURCE STRING NOT NULL, FIRST_CAREUNIT STRING NOT NULL, LAST_CAREUNIT STRING NOT NULL, "
        "FIRST_WARDID SMALLINT NOT NULL, LAST_WARDID SMALLINT NOT NULL, INTIME TIMESTAMP NOT NULL, "
        "OUTTIME TIMESTAMP, LOS DOUBLE",
        ("ICUSTAY_ID",),
        (_fk("SUBJECT_ID", "PATIENTS"), _fk("HADM_ID", "ADMISSIONS")),
    ),
    "D_ITEMS": TableSpec(
        "D_ITEMS",
        "ROW_ID BIGINT NOT NULL, ITEMID INT NOT NULL, LABEL STRING NOT NULL, ABBREVIATION STRING, "
        "DBSOURCE STRING NOT NULL, LINKSTO STRING, CATEGORY STRING, UNITNAME STRING, PARAM_TYPE STRING, "
        "CONCEPTID INT",
        ("ITEMID",),
    ),
    "D_LABITEMS": TableSpec(
        "D_LABITEMS",
        "ROW_ID BIGINT NOT NULL, ITEMID INT NOT NULL, LABEL STRING NOT NULL, FLUID STRING NOT NULL, "
        "CATEGORY STRING NOT NULL, LOINC_CODE STRING",
        ("ITEMID",),
    ),
    "CAREGIVERS": TableSpec(
        "CAREGIVERS",
        "ROW_ID BIGINT NOT NULL, CGID INT NOT NULL, LABEL STRING, DESCRIPTION STRING",
        ("CGID",),
    ),
    "D_ICD_DIAGNOSES": TableSpec(
        "D_ICD_DIAGNOSES",
        "ROW_ID BIGINT NOT NULL, ICD9_CODE STRING NOT NULL, SHORT_TITLE STRING NOT NULL, LONG_TITLE STRING NOT NULL",
        ("ICD9_CODE",),
    ),
    "DIAGNOSES_ICD": TableSpec(
        "DIAGNOSES_ICD",
        "ROW_ID BIGINT NOT NULL, SUBJECT_ID INT NOT NULL, HADM_ID INT NOT NULL, SEQ_NUM INT, ICD9_CODE STRING",
        (),
        (_fk("SUBJECT_ID", "PATIENTS"), _fk("HADM_ID", "ADMISSIONS"), _fk("ICD9_CODE", "D_ICD_DIAGNOSES")),
    ),
    "CALLOUT": TableSpec(
        "CALLOUT",
        "ROW_ID BIGINT NOT NULL, SUBJECT_ID INT NOT NULL, HADM_ID INT NOT NULL, SUBMIT_WARDID INT, "
        "SUBMIT_CAREUNIT STRING, CURR_WARDID INT, CURR_CAREUNIT STRING, CALLOUT_WARDID INT, "
        "CALLOUT_SERVICE STRING, REQUEST_TELE SMALLINT, REQUEST_RESP SMALLINT, REQUEST_CDIFF SMALLINT, "
        "REQUEST_MRSA SMALLINT, REQUEST_VRE SMALLINT, CALLOUT_STATUS STRING, CALLOUT_OUTCOME STRING, "
        "DISCHARGE_WARDID INT, ACKNOWLEDGE_STATUS STRING, CREATETIME TIMESTAMP, UPDATETIME TIMESTAMP, "
        "ACKNOWLEDGETIME TIMESTAMP, OUTCOMETIME TIMESTAMP, FIRSTRESERVATIONTIME TIMESTAMP, "
        "CURRENTRESERVATIONTIME TIMESTAMP",
        (),
        (_fk("SUBJECT_ID", "PATIENTS"), _fk("HADM_ID", "ADMISSIONS")),
    ),
    "CHARTEVENTS": TableSpec(
        "CHARTEVENTS",
        "ROW_ID BIGINT NOT NULL, SUBJECT_ID INT NOT NULL, HADM_ID INT, ICUSTAY_ID INT, ITEMID INT NOT NULL, "
        "CHARTTIME TIMESTAMP NOT NULL, STORETIME TIMESTAMP, CGID INT, VALUE STRING, VALUENUM DOUBLE, "
        "VALUEUOM STRING, WARNING SMALLINT, ERROR SMALLINT, RESULTSTATUS STRING, STOPPED STRING",
        (),
        (_fk("SUBJECT_ID", "PATIENTS"), _fk("HADM_ID", "ADMISSIONS"), _fk("ICUSTAY_ID", "ICUSTAYS"),
         _fk("ITEMID", "D_ITEMS")),
        notes="range layout on ITEMID",
    ),
    "LABEVENTS": TableSpec(
        "LABEVENTS",
        "ROW_ID BIGINT NOT NULL, SUBJECT_ID INT NOT NULL, HADM_ID INT, ITEMID INT NOT NULL, "
        "CHARTTIME TIMESTAMP NOT NULL, VALUE STRING, VALUENUM DOUBLE, VALUEUOM STRING, FLAG STRING",
        (),
        (_fk("SUBJECT_ID", "PATIENTS"), _fk("HADM_ID", "ADMISSIONS"), _fk("ITEMID", "D_LABITEMS")),
        notes="range layout on year(CHARTTIME)",
    ),
    "INPUTEVENTS_CV": TableSpec(
        "INPUTEVENTS_CV",
        "ROW_ID BIGINT NOT NULL, SUBJECT_ID INT NOT NULL, HADM_ID INT, ICUSTAY_ID INT, CHARTTIME TIMESTAMP NOT NULL, "
        "ITEMID INT NOT NULL, AMOUNT DOUBLE, AMOUNTUOM STRING, RATE DOUBLE, RATEUOM STRING, "
        "STORETIME TIMESTAMP, CGID INT, ORDERID INT, LINKORDERID INT, STOPPED STRING, NEWBOTTLE INT, "
        "ORIGINALAMOUNT DOUBLE, ORIGINALAMOUNTUOM STRING, ORIGINALROUTE STRING, ORIGINALRATE DOUBLE, "
        "ORIGINALRATEUOM STRING, ORIGINALSITE STRING",
        (),
        (_fk("SUBJECT_ID", "PATIENTS"), _fk("HADM_ID", "ADMISSIONS"), _fk("ICUSTAY_ID", "ICUSTAYS"),
         _fk("ITEMID", "D_ITEMS")),
    ),
    "INPUTEVENTS_MV": TableSpec(
        "INPUTEVENTS_MV",
        "ROW_ID BIGINT NOT NULL, SUBJECT_ID INT NOT NULL, HADM_ID INT, ICUSTAY_ID INT, STARTTIME TIMESTAMP NOT NULL, "
        "ENDTIME TIMESTAMP NOT NULL, ITEMID INT NOT NULL, AMOUNT DOUBLE, AMOUNTUOM STRING, RATE DOUBLE, "
        "RATEUOM STRING, STORETIME TIMESTAMP, CGID BIGINT, ORDERID INT, LINKORDERID INT, "
        "ORDERCATEGORYNAME STRING, SECONDARYORDERCATEGORYNAME STRING, ORDERCOMPONENTTYPEDESCRIPTION STRING, "
        "ORDERCATEGORYDESCRIPTION STRING, PATIENTWEIGHT DOUBLE, TOTALAMOUNT DOUBLE, TOTALAMOUNTUOM STRING, "
        "ISOPENBAG SMALLINT, CONTINUEINNEXTDEPT SMALLINT, CANCELREASON SMALLINT, STATUSDESCRIPTION STRING, "
        "ORIGINALAMOUNT DOUBLE, ORIGINALRATE DOUBLE",
        (),
        (_fk("SUBJECT_ID", "PATIENTS"), _fk("HADM_ID", "ADMISSIONS"), _fk("ICUSTAY_ID", "ICUSTAYS"),
         _fk("ITEMID", "D_ITEMS")),
    ),
    "OUTPUTEVENTS": TableSpec(
        "OUTPUTEVENTS",
        "ROW_ID BIGINT NOT NULL, SUBJECT_ID INT NOT NULL, HADM_ID INT, ICUSTAY_ID INT, CHARTTIME TIMESTAMP NOT NULL, "
        "ITEMID INT NOT NULL, VALUE DOUBLE, VALUEUOM STRING, STORETIME TIMESTAMP, CGID BIGINT, STOPPED STRING, "
        "NEWBOTTLE INT, ISERROR SMALLINT",
        (),
        (_fk("SUBJECT_ID", "PATIENTS"), _fk("HADM_ID", "ADMISSIONS"), _fk("ICUSTAY_ID", "ICUSTAYS"),
         _fk("ITEMID", "D_ITEMS")),
    ),
    "DATETIMEEVENTS": TableSpec(
        "DATETIMEEVENTS",
        "ROW_ID BIGINT NOT NULL, SUBJECT_ID INT NOT NULL, HADM_ID INT, ICUSTAY_ID INT, ITEMID INT NOT NULL, "
        "CHARTTIME TIMESTAMP NOT NULL, STORETIME TIMESTAMP, CGID INT, VALUE TIMESTAMP, VALUEUOM STRING, "
        "WARNING SMALLINT, ERROR SMALLINT, RESULTSTATUS STRING, STOPPED STRING",
        (),
        (_fk("SUBJECT_ID", "PATIENTS"), _fk("HADM_ID", "ADMISSIONS"), _fk("ICUSTAY_ID", "ICUSTAYS"),
         _fk("ITEMID", "D_ITEMS")),
    ),
    "MICROBIOLOGYEVENTS": TableSpec(
        "MICROBIOLOGYEVENTS",
        "ROW_ID BIGINT NOT NULL, SUBJECT_ID INT NOT NULL, HADM_ID INT, CHARTDATE TIMESTAMP, CHARTTIME TIMESTAMP, "
        "SPEC_ITEMID INT, SPEC_TYPE_DESC STRING, ORG_ITEMID INT, ORG_NAME STRING, ISOLATE_NUM SMALLINT, "
        "AB_ITEMID INT, AB_NAME STRING, DILUTION_TEXT STRING, DILUTION_COMPARISON STRING, "
        "DILUTION_VALUE DOUBLE, INTERPRETATION STRING",
        (),
        (_fk("SUBJECT_ID", "PATIENTS"), _fk("HADM_ID", "ADMISSIONS")),
    ),
}


def table_spec(name: str) -> TableSpec:
    return TABLES[name.upper()]


def schema_of(name: str) -> StructType:
    return table_spec(name).schema()
