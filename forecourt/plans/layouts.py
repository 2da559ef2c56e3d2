"""Headers of the delivered files and columns of the source tables.

Each layout maps a delivered name to ours. Two files carry headers that differ from
site to site; their layouts take those headers as arguments.
"""

from __future__ import annotations

from forecourt.operators.schema import TableSpec

OFFER_COLUMNS = (
    "vehicle", "offer_code", "brand", "dealer_code", "order_date", "trim", "trim_label", "accessories",
    "accessories_before_tax", "trade_in_aid", "extra_fees", "discount_before_tax", "total_discount", "final_price",
    "tariff_before_tax", "tariff", "options", "options_before_tax", "conversion_bonus", "service_contract",
    "emission_bonus", "trade_in_valuation", "conversions_before_tax", "conversions", "registration_levy",
    "repurchase_before_tax", "tax_deduction", "country",
)

# Offers, columns both countries deliver under the same header.
OFFERS_SHARED = {
    "CDC_NUMVIN": "vehicle",
    "CRE_MARCA": "brand",
    "NCL_CODCRE": "dealer_code",
    "DATE_COMANDE": "order_date",
    "FINITION": "trim",
    "FIN_LFINITIONAO": "trim_label",
    "ACC": "accessories",
    "ACC_PRE": "accessories_before_tax",
    "TOTAL_REMISE_PRE": "discount_before_tax",
    "TOTAL_REMISE": "total_discount",
    "PRIX_FINAL": "final_price",
    "TARIF_VEHICULE_PRE": "tariff_before_tax",
    "TARIF_VEHICULE": "tariff",
    "OPCIONES": "options",
    "OPCIONES_PRE": "options_before_tax",
    "NCL_VO_VALON": "trade_in_valuation",
    "country": "country",
}
OFFERS = {
    "FR": TableSpec(
        OFFERS_SHARED
        | {
            "COD_OFR": "offer_code",
            "NCL_VO_IMPAYUDAREC": "trade_in_aid",
            "FRAIS_ANEXXES": "extra_fees",
            "NCL_VO_PRIMACONVERSION": "conversion_bonus",
            "CONTRAT_SERVICE": "service_contract",
            "BONUS_MALUS": "emission_bonus",
            "TRANSFORMATIONS_PRE": "conversions_before_tax",
            "TRANSFORMATIONS": "conversions",
            "Taxe parafiscale": "registration_levy",
            "VEHICULE_REPENDRE_PRE": "repurchase_before_tax",
        },
        missing={"tax_deduction": "string"},
        order=OFFER_COLUMNS,
    ),
    "SP": TableSpec(
        OFFERS_SHARED
        | {
            "NCL_CODOF": "offer_code",
            "SUPLIDOS": "extra_fees",
            "TOTAL_SERVICIOS": "service_contract",
            "DEDUCCION_IMPUESTOS": "tax_deduction",
        },
        missing=dict.fromkeys(
            (
                "trade_in_aid", "conversion_bonus", "emission_bonus", "conversions", "conversions_before_tax",
                "repurchase_before_tax", "registration_levy",
            ),
            "string",
        ),
        order=OFFER_COLUMNS,
    ),
}

BUDGET = TableSpec(
    {
        "Marque": "brand",
        "LIB PAYS": "country",
        "mois": "month",
        "TYPE": "vehicle_type",
        "LIB SS FAM 2": "family",
        "ENERGIE": "energy",
        "canal AE": "channel",
        "volume": "volume",
        "PVR unit": "price_unit",
        "MCV unit": "margin_unit",
        "RBCV unit": "net_revenue_unit",
        "Prime performance unit": "performance_unit",
        "Promo client final unit": "client_promo_unit",
        "Aides société unit": "company_aid_unit",
        "Prime diff unit": "dealer_bonus_unit",
        "Buy back unit": "buy_back_unit",
        "taux MCV RC130": "margin_rate",
        "PVR": "price",
        "MCV": "margin",
        "RBCV": "net_revenue",
        "RM035": "rm035",
        "RM036": "rm036",
        "RM037": "rm037",
        "RM039": "rm039",
        "RM280": "rm280",
        "Year": "year",
        "Date": "date",
    }
)

DEALERS = TableSpec(
    {
        "Pays": "country",
        "Marque": "brand",
        "Acteur": "dealer_code",
        "Identifiant du site géographique marqué": "site_id",
        "Identifiant du site géographique parent": "parent_site_id",
        "Nom commercial": "dealer_name",
        "Adresse": "address",
        "Code postal": "postal_code",
        "Ville": "city",
        "Code DR VN": "region_code",
        "Libellé DR VN": "region_name",
        "Code Secteur VN": "sector_code",
        "Libellé Secteur VN": "sector_name",
        "Code contrat": "contract_code",
        "Principale/": "rank",
    }
)

PROMOTIONS = TableSpec({"Brand": "brand", "Opc": "operation_label", "Category": "category", "country": "country"})
FAMILIES = TableSpec({"family": "family", "Brand": "brand", "familytomap": "family_to_map"})
TAX_RATES = TableSpec({"country": "country", "taxrate": "tax_rate"})
CATEGORY_ORDER = TableSpec({"Client promotions": "category", "Order": "position"})
CLASSES = TableSpec({"VME Category": "category", "Classification": "class"})
MARGINS = TableSpec({"Key Margin": "key", "Marge_u": "margin"})
CHANNEL_TYPES = TableSpec(
    {
        "cleCANAL (code pays - marque - canal de distribution - type clientèle majeure - type clientèle mineure)": "key",
        "CanalType": "channel_type",
    }
)


def channels(forecast_name: str, sales_name: str, budget_name: str) -> TableSpec:
    """Channel table; the headers name the three systems whose labels it maps."""
    return TableSpec(
        {"channel": "channel", forecast_name: "forecast_name", sales_name: "sales_name", budget_name: "budget_name"}
    )


def forecast(subfamily: str) -> TableSpec:
    """Forecast, headers as they read after cleaning."""
    return TableSpec(
        {
            "MARQUE_DE_DISTRIBUTION": "brand",
            "CYCLE": "cycle",
            "LIBELLE_ZDS": "zone_label",
            "MOIS_DE_LIVRAISON": "month",
            subfamily: "subfamily_label",
            "LIBELLE_TYPE_DE_CLIENTELE_MAJEUR": "client_type",
            "LIBELLE_TYPE_D_ENERGIE": "energy",
            "VOLUME_AJ": "volume",
            "PRIX_VENTE_AJ": "price",
            "PRIX_VENTE_AJ_DEV": "price_currency",
            "MACOM_CONSO_AJ": "margin",
            "PV_VERSION": "version_price",
            "PV_OPTIONS": "options_price",
            "MACOM_CONSO_OPTION": "margin_option",
            "MCX_VARIABLES_AJ": "promo_cost",
            "RM035": "rm035",
            "RM036": "rm036",
            "RM037": "rm037",
            "RM039": "rm039",
            "RM280": "rm280",
            "RBCV_AJ": "net_revenue",
            "LIBELLE_PAYS": "country",
            "Channel": "channel",
            "Marque": "brand_label",
            "Finition_Commerce": "trim",
            "List_price_u": "list_price_unit",
        }
    )


# Registration system. The table of professions is expected as ``code`` and ``label``.
REGISTRATION_TABLES = {
    "lines": {
        "NOVIN": "vehicle",
        "DATCCLT": "order_date",
        "DATVENT": "sale_date",
        "TYPUTIL": "usage",
        "NEDC": "co2",
        "HABEXTT": "trim_colour",
        "HABEXTC": "trim_material",
        "COD_MOTOR": "engine",
        "QI_FILIAL": "affiliate",
        "NUMCCLT": "order_no",
        "CODCPER": "pack",
        "VERSION_CCO": "pack_version",
        "NOCAF": "file_no",
        "CODCPRO": "profession",
        "VPVU": "vehicle_type",
        "VERS14": "version_code",
    },
    "countries": {"QI_FILIAL": "affiliate", "LIBELLE_FRANCAIS": "country_label"},
    "orders": {
        "QI_FILIAL": "affiliate",
        "NUMCCLT": "order_no",
        "CODOP1": "operation_1",
        "CODOP2": "operation_2",
        "CODOP3": "operation_3",
        "CODOP4": "operation_4",
        "CODOP5": "operation_5",
        "CODPROM": "promo",
        "CODPROM2": "promo_2",
        "REMIPOUR": "discount_percent",
    },
    "affiliates": {"QC_FILIAL": "affiliate"},
    "engines": {"COD_MOTOR": "engine", "QI_FILIAL": "affiliate", "ENERGIA": "energy"},
    "vehicles": {
        "QI_FILIAL": "affiliate",
        "NOVIN": "vehicle",
        "INDDEMO": "demo",
        "DATIMMAT": "registered_on",
        "DATMAD": "available_on",
        "DATEXPC": "shipped_on",
        "DATARCR": "arrived_on",
        "DATPROD": "production_date",
    },
    "usages": {"TYPUTIL": "usage", "QI_FILIAL": "affiliate"},
    "packs": {"QI_FILIAL": "affiliate", "CODCPER": "pack", "VERSION": "version", "LIBCOMBIPACK": "pack_label"},
    "financing": {"NOCAF": "file_no", "QI_FILIAL": "affiliate", "DATMRES": "reserved_on"},
    "movements": {
        "QI_FILIAL": "affiliate",
        "NOVIN": "vehicle",
        "DATMEC": "in_service_on",
        "DATDEM": "demo_end",
        "DATIMM": "registered_on",
    },
    "professions": {"code": "code", "label": "label"},
    "families": {
        "QI_FILIAL": "affiliate",
        "VPVU": "vehicle_type",
        "FAMILLE": "family",
        "LIBFAMI": "family_label",
        "MARQUE": "brand",
    },
}

# Sales system: keys and labels most dimensions share.
CODE = {"ID": "id", "CODE": "code"}
LABELS = {"LIB_FR": "label_fr", "LIB_EN": "label_en", "LIB_ES": "label_es"}
ZONE = {"ID_ZDS": "zone_id"}
SALES_TABLES = {
    "facts": {
        "ID_ZDS": "zone_id",
        "ID_CMP": "company_id",
        "ID_SCD": "group_id",
        "ID_CLI": "client_id",
        "ID_CLI_LIV": "delivered_id",
        "ID_CMI": "minor_client_type_id",
        "ID_BAS": "base_id",
        "ID_RUB": "heading_id",
        "ID_FAM": "family_id",
        "ID_SFA": "subfamily_id",
        "ID_VER": "version_id",
        "ID_SEG": "segment_id",
        "ID_CND": "channel_id",
        "ID_CMA": "major_client_type_id",
        "ID_OPC": "operation_id",
        "ID_VIN": "vehicle_id",
        "DT_FACT": "invoice_date",
        "DT_VD": "sale_date",
        "DT_COMM_CLI_FIN_VD": "order_date",
        "DATIMM": "registered_on",
        "TYPE_FLOTTE_VD": "fleet_type",
        "TYPE_OPE_ESSOR": "fleet_operation",
        "TYP_UTIL_VD": "usage",
        "CODE_PROFESSION_VD": "profession",
        "CODE_PROMO": "promo",
        "CODE_PROMO2": "promo_2",
        "VOLUME_AJ": "volume",
        "PRIX_VENTE": "price_raw",
        "PRIX_VENTE_AJ": "price",
        "PV_OPTIONS": "options_price",
        "PV_VERSION": "version_price",
        "MACOM_CONSO": "margin_raw",
        "MACOM_CONSO_AJ": "margin",
        "MACOM_CONSO_VERSION": "margin_version",
        "MACOM_CONSO_OPTION": "margin_option",
        "MACOM_ENTITE": "entity_margin_raw",
        "MACOM_ENTITE_AJ": "entity_margin",
        "MACOM_ENTITE_VERSION": "entity_margin_version",
        "MACOM_ENTITE_OPTION": "entity_margin_option",
        "RBCV_AJ": "net_revenue",
        "MCX_VARIABLES": "promo_cost",
        "CT_STOCKAGE": "storage_cost",
    },
    "company": ZONE | CODE | LABELS,
    "client": ZONE | {"ID_SCD": "group_id"} | CODE | LABELS,
    "minor_client_type": ZONE | CODE | LABELS,
    "base": CODE,
    "zone": CODE | LABELS,
    "heading": CODE | LABELS,
    "family": ZONE | CODE | LABELS | {"ID_MRQ_COM": "brand_id"},
    "subfamily": ZONE | CODE | LABELS,
    "version": ZONE | CODE | LABELS,
    "segment": ZONE | CODE | LABELS,
    "channel": CODE | LABELS,
    "major_client_type": CODE | LABELS,
    "operation": ZONE | CODE | LABELS,
    "vehicle": ZONE | CODE,
    "brand": CODE,
}

# Amounts are decimals, so that their sums are exact; six decimals cover the shares of a cent in the fact.
SALES_TYPES = dict.fromkeys(
    (
        "volume", "price_raw", "price", "options_price", "version_price", "margin_raw", "margin", "margin_version",
        "margin_option", "entity_margin_raw", "entity_margin", "entity_margin_version", "entity_margin_option",
        "net_revenue", "promo_cost", "storage_cost",
    ),
    "decimal(28,6)",
)
