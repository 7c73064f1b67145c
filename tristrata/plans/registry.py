"""Which extracts exist, and the cleansing rules of each."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from tristrata.operators.projection import AS_READ, Field

# System, extract file, cleansed table, key columns, date columns.
# "-" stands for none.
_RULES = """
SAP  AUSP                     ausp                     OBJEK,ATINN                                -
SAP  AUSP_BATCH               ausp_batch               OBJEK,ATNAM                                -
SAP  EKBE                     ekbe                     EBELN,EBELP,ZEKKN,VGABE,GJAHR,BELNR,BUZEI  BUDAT,CPUDT
SAP  EKET                     eket                     EBELN,EBELP,ETENR                          EINDT,SLFDT,LPEIN
SAP  EKKO                     ekko                     EBELN                                      AEDAT,BEDAT
SAP  EKPO                     ekpo                     EBELN,EBELP                                -
SAP  LFA1                     lfa1                     LIFNR                                      ERDAT
SAP  LFB1                     lfb1                     LIFNR,BUKRS                                -
SAP  LFM1                     lfm1                     LIFNR,EKORG                                -
SAP  MAKT                     makt                     MATNR,SPRAS                                -
SAP  MARA                     mara                     MATNR                                      ERSDA,LAEDA
SAP  MARC                     marc                     MATNR,WERKS                                -
SAP  MARCH                    march                    -                                          -
SAP  MARD                     mard                     MATNR,WERKS,LGORT                          -
SAP  MARDH                    mardh                    -                                          -
SAP  MBEW                     mbew                     MATNR,BWKEY                                -
SAP  MBEWH                    mbewh                    -                                          -
SAP  MCH1                     mch1                     MATNR,CHARG                                ERSDA,HSDAT,VFDAT
SAP  MCHB                     mchb                     MATNR,WERKS,LGORT,CHARG                    -
SAP  MCHBH                    mchbh                    -                                          -
SAP  MSLB                     mslb                     MATNR,CHARG,SOBKZ                          -
SAP  MSLBH                    mslbh                    -                                          -
SAP  PLKO                     plko                     -                                          -
SAP  QALS                     qals                     -                                          PASTRTERM,ERSTELLDAT
SAP  QAVE                     qave                     -                                          -
SAP  T001                     t001                     BUKRS                                      -
SAP  T001K                    t001k                    BWKEY                                      -
SAP  T001L                    t001l                    WERKS,LGORT                                -
SAP  T001W                    t001w                    WERKS                                      -
SAP  T023T                    t023t                    MATKL,SPRAS                                -
SAP  T024                     t024                     EKGRP                                      -
SAP  T024E                    t024e                    EKORG                                      -
SAP  T077K                    t077k                    KTOKK                                      -
SAP  T134T                    t134t                    MTART,SPRAS                                -
SAP  TCURF                    tcurf                    -                                          GDATU
SAP  TQ30T                    tq30t                    -                                          -
SAP  TQ31T                    tq31t                    -                                          -
IBP  demand_actual            demand_actual            period,material,market                     -
IBP  demand_forcast           demand_forecast          period,material,market                     -
IBP  master_customer          master_customer          Customer_ID                                -
IBP  master_customer_product  master_customer_product  Customer_ID,Product_ID                     -
IBP  master_location          master_location          Location_ID                                -
IBP  master_location_product  master_location_product  Location_ID,Product_ID                     -
"""


@dataclass(frozen=True)
class Rule:
    """One extract: where it comes from and how it is cleansed. ``multi_line`` says that its
    texts hold line breaks."""

    system: str
    extract: str
    table: str
    keys: tuple[str, ...] = ()
    dates: tuple[str, ...] = ()
    multi_line: bool = False

    @property
    def raw_table(self) -> str:
        return f"{self.system}_{self.extract}".lower()


def _names(cell: str) -> tuple[str, ...]:
    return () if cell == "-" else tuple(cell.split(","))


def parse_rules(text: str) -> tuple[Rule, ...]:
    rows = (line.split() for line in text.strip().splitlines())
    return tuple(Rule(s, e, t, _names(k), _names(d)) for s, e, t, k, d in rows)


RULES = parse_rules(_RULES)

Keyed = Mapping[str, Sequence[str]]


def keyed_tables(rules: Iterable[Rule]) -> dict[str, tuple[str, ...]]:
    """The columns by which each cleansed table has one row per value; tables without any are left out."""
    return {r.table: r.keys for r in rules if r.keys}


KEYED = keyed_tables(RULES)


def is_unique(
    table: str, layout: Sequence[Field], keys: Sequence[str], keyed: Keyed = KEYED, fixed: Sequence[str] = ()
) -> bool:
    """Whether the cleansing rules prove that a table has one row at most per value of ``keys``.

    ``keys`` are names that ``layout`` gives, ``fixed`` source columns that a filter holds to one value. A key
    column that the layout leaves out, or casts (two texts may be one number), proves nothing."""
    names = {f.source.lower(): f.name for f in layout if f.type in (AS_READ, "string")}
    held = {f.lower() for f in fixed}
    wanted = [k.lower() for k in keyed.get(table, ()) if k.lower() not in held]
    return bool(keyed.get(table)) and all(names.get(k) in set(keys) for k in wanted)
