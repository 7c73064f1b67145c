"""A small invented business: every extract as CSV text."""

# A table not listed here has a header and no rows, with these columns.
EMPTY = {
    "AUSP": "MANDT,OBJEK,ATINN", "AUSP_BATCH": "MANDT,OBJEK,ATNAM", "MARC": "MANDT,MATNR,WERKS",
    "MARCH": "MANDT", "MSLBH": "MANDT", "PLKO": "MANDT", "T001K": "MANDT,BWKEY",
    "T023T": "MANDT,MATKL,SPRAS", "T134T": "MANDT,MTART,SPRAS", "TCURF": "MANDT,GDATU",
    "TQ30T": "MANDT", "TQ31T": "MANDT",
}

SAP = {
    "MARA": """MATNR,MTART,MATKL,MEINS,VPSTA,PSTAT,MSTAE,ERSDA,LAEDA
 0001 ,ROH,G1,KG,K,"",,20230105,00000000
0002,FERT,G2,,,,,20230230,20240101
0002,FERT,G2,,,,,20230230,20240101""",
    "MAKT": "MATNR,SPRAS,MAKTX\n0001,E,Steel\n0001,D,Stahl\n0002,D,Blech",
    "MARD": "MATNR,WERKS,LGORT,LABST,INSME,SPEME\n0001,P1,L1,10,1,0",
    "MARDH": "MATNR,WERKS,LGORT,LFGJA,LFMON,LABST\n0001,P1,L1,2024,02,9",
    "MBEW": "MATNR,BWKEY,VERPR,STPRS,PEINH,BWTAR,BKLAS\n0001,P1,2.50,2.40,1,,3000",
    "MBEWH": "MATNR,BWKEY,LFGJA,LFMON,VERPR,STPRS\n0001,P1,2024,02,2.00,1.90",
    "MCH1": "MATNR,CHARG,ERSDA,HSDAT,VFDAT,LAEDA\n0001,B1,20240101,20240102,bad,x",
    "MCHB": """MATNR,WERKS,LGORT,CHARG,CLABS,CUMLM,CINSM,CSPEM
0001,P1,L1,B1,1.000,5,2,3
0001,P1,L1,B2,1.000,5,,2.000
0002,P2,L9,B3,4,0,0,0""",
    "MCHBH": """MATNR,WERKS,LGORT,CHARG,LFGJA,LFMON,CLABS,CUMLM,CINSM,CSPEM
0001,P1,L1,B1,2024,02,1,0,1,1
0001,P1,L1,B2,2024,02,2,0,0,0
0001,P1,L1,B1,2024,13,1,0,0,0""",
    "MSLB": "MATNR,WERKS,CHARG,SOBKZ,LBLAB\n0001,P1,B1,E,7\n0001,P1,B1,K,8",
    "EKKO": """EBELN,BUKRS,BSART,LIFNR,EKORG,EKGRP,WAERS,STATU,BEDAT,ERNAM,AEDAT
4500,C1,NB,V1,O1,G1,EUR,9,20240110,me,20240111
4501,C1,ZARB,V9,O1,G9,EUR,9,20240110,me,bad
4502,C1,UB,V1,O9,G1,EUR,9,,me,
4503,C1,ZZ,V1,O1,G1,EUR,9,20240110,me,20240111""",
    "EKPO": """EBELN,EBELP,MATNR,BUKRS,WERKS,LGORT,MATKL,TXZ01,MEINS,PSTYP,MENGE,NETPR
4500,10,0001,C1,P1,L1,G1,steel,KG,L,10,2.50
4500,20,0002,C9,P9,L1,G1,sheet,KG,,1,1
4501,10,0001,C1,P1,L1,G1,steel,KG,K,3,2
4502,10,0001,C1,P1,L1,G1,steel,KG,L,4,2
4999,10,0001,C1,P1,L1,G1,steel,KG,L,4,2""",
    "EKET": """EBELN,EBELP,ETENR,EINDT,SLFDT,LPEIN,MENGE,WEMNG
4500,10,1,20240201,20240201,1,6,1
4500,10,2,20240301,20240301,1,4,4
4501,10,1,20240301,20240301,1,3,""",
    "EKBE": """EBELN,EBELP,ZEKKN,VGABE,GJAHR,BELNR,BUZEI,BUDAT,CPUDT,MENGE,DMBTR
4500,10,0,1,2024,d1,1,20240205,20240205,3,7.50
4500,10,0,1,2024,d2,1,20240206,20240206,2,5.00
4500,10,0,2,2024,d3,1,20240206,20240206,9,9.00""",
    "LFA1": "LIFNR,NAME1,LAND1,ORT01,PSTLZ,STRAS,KTOKK,ERDAT\nV1,Vendor,DE,Ulm,08900,Weg,Z001,20200101\nV2,Other,DE,,,,,",
    "LFB1": "LIFNR,BUKRS,INTAD\nV1,C1,a@x\nV1,C2,a@x\nV1,C3,b@x",
    "LFM1": "LIFNR,EKORG,WAERS,ZTERM,INCO1\nV1,O1,EUR,Z30,FOB\nV1,O2,USD,Z30,FOB",
    "QALS": """PRUEFLOS,WERK,ART,MATNR,LIFNR,EBELN,EBELP,ENSTEHDAT,ERSTELDAT,BUDAT,LOSMENGE,GESSTICHPR
1,P1,04,0001,V1,4500,10,20240101,20240101,20240101,5,1
2,P1,01,0001,V1,4500,10,20240101,20240101,20240101,5,1
3,P1,,0001,V1,4500,10,20240101,20240101,20240101,5,1
4,P1,04,0001,V1,4500,10,20240101,20240101,20240101,5,1""",
    "QAVE": "PRUEFLOS,VWERKS,VBEWERTUNG,DBEWERTUNG,VFOLGEAKTI,VDATUM,VAUSWAHLMG\n1,P1,A,,,20240105,5\n2,P1,R,X,BLOCK,20240105,4",
    "T001": "BUKRS,BUTXT\nC1,Company",
    "T001L": "WERKS,LGORT,LGOBE\nP1,L1,Bin one\nP1,L2,Bin two",
    "T001W": "WERKS,NAME1,ORT01,LAND1,REGIO\nP1,Plant,Ulm,DE,BW\nP2,Empty plant,Bonn,DE,NW",
    "T024": "EKGRP,EKNAM\nG1,Group",
    "T024E": "EKORG,EKOTX\nO1,Org",
    "T077K": 'DURAS,KTOKD,KTOKK,NUMKR\nX,0001,Z001,03\n"",0001,Z002,03',
}

_FORECASTS = (
    "consensus_demand,ibp_consensus_forecast,ibp_forecast,budget_volumes,sc_forecast_override,"
    "statistical_forecast,upside,"
    + ",".join(f"fcst_snapshot_{i}" for i in range(1, 13))
    + ",fcst_variance_snapshot_2,fcst_variance_snapshot_3,fcst_variance_perc_snapshot_2,"
    "fcst_variance_perc_snapshot_3,ibp_consensus_forecast_prior"
)
IBP = {
    "demand_actual": "period,material,market,period_id,actual_qty,actual_revenue,shipped_qty,delivered_qty,"
    "net_actual_qty,net_revenue,service_level\n202401,0001,M1,7,1.5,2.25,1,1,1,2,0.98765\n"
    "202413,0001,M1,7,1,,1,1,1,2,x",
    "demand_forcast": f"period,material,market,period_id,{_FORECASTS}\n202402,0001,M1,8,"
    + ",".join(str(i) for i in range(1, 25)),
    "master_customer": "Customer ID,Customer Description,Customer Region,Customer Country/Region,Demand Type,"
    "Demand Sub-Type,Latitude,Longttitude,Demand Sub Type\nM1,Market,EU,DE,base,old,48.5,9.75,new",
    "master_customer_product": "CUSTOMER_ID,PRODUCT_ID,MARKET_SEGMENT,REMAINING_SHELF_LIFE\nM1,0001,retail,30",
    "master_location": "LOCATION_ID,LOCATION_DESCRIPTION,LOCATION_REGION,LOCATION_TYPE,LATITUDE,LONGTTITUDE\n"
    "P1,Plant,EU,DC,48.5,bad",
    "master_location_product": "Location (ID),Product (ID),Material Description,Plant Exclusion = X,Market DC (X)\n"
    "P1,0001,Steel,X,",
}


def write_extracts(folder):
    """Write every extract; returns the folder of each source system."""
    folders = {}
    for system, tables in (("SAP", SAP | EMPTY), ("IBP", IBP)):
        place = folder / system
        place.mkdir(parents=True)
        for name, text in tables.items():
            (place / f"{name}.csv").write_text(text + "\n")
        folders[system] = str(place)
    return folders
