"""Codes and names agreed with the source systems and the reports."""

from __future__ import annotations

# Country codes of the sales zones and the extracts.
COUNTRY_CODES = {
    "AT": "Austria",
    "BE": "Belgium",
    "DE": "Germany",
    "ES": "Spain",
    "FR": "France",
    "GB": "Great Britain",
    "IT": "Italy",
    "NL": "Netherlands",
    "PL": "Poland",
    "PT": "Portugal",
    "SP": "Spain",
}

# French country labels of the registration system.
FRENCH_COUNTRIES = {
    "Allemagne": "Germany",
    "Autriche": "Austria",
    "Belgique": "Belgium",
    "Espagne": "Spain",
    "France": "France",
    "Gde-Bretagne": "Great Britain",
    "Grande": "Great Britain",
    "Italie": "Italy",
    "Pays": "Netherlands",
    "Pays Bas": "Netherlands",
    "Pays-bas": "Netherlands",
    "Pologne": "Poland",
    "Portugal": "Portugal",
}

# Country names in capitals, French and English, as extracts spell them.
CAPITAL_COUNTRIES = {
    "ALLEMAGNE": "Germany",
    "AUSTRIA": "Austria",
    "AUTRICHE": "Austria",
    "BELGIQUE": "Belgium",
    "BELUX": "Belgium",
    "ESPAGNE": "Spain",
    "FRANCE": "France",
    "GERMANY": "Germany",
    "ITALIE": "Italy",
    "ITALY": "Italy",
    "NETHERLANDS": "Netherlands",
    "PAYS BAS": "Netherlands",
    "POLAND": "Poland",
    "POLOGNE": "Poland",
    "PORTUGAL": "Portugal",
    "SPAIN": "Spain",
    "UNITED KINGDOM": "Great Britain",
}

# Perimeter of the marts.
BRANDS = ("AP", "AC", "DS")
OFFER_COUNTRIES = ("FR", "SP")
REGISTRATION_COUNTRIES = (
    "France", "Germany", "Portugal", "Austria", "Belgium", "Italy", "Spain", "Great Britain", "Netherlands", "Poland",
)
FAMILY_AFFILIATES = ("83", "84")
OWN_REGISTRATION_AFFILIATES = (1, 63)
SALES_BASE = "LA"
SALES_ZONES = (
    "CPBE", "PPBE", "CPFR", "PPFR", "CPIT", "PPIT", "CPES", "PPES", "CPGB", "PPGB",
    "CPNL", "PPNL", "CPPL", "PPPL", "CPAT", "PPAT", "CPPT", "PPPT", "CPDE", "PPDE",
)

# Recodes of single columns.
VEHICLE_TYPES = {"VP": "PC", "VU": "CV"}
ENERGIES = {
    "DIESEL": "Diesel",
    "ELECTRICO": "Electric",
    "ELECTRIQUE": "Electric",
    "ESSENCE": "Petrol",
    "GASOLINA": "Petrol",
    "Gasolina": "Petrol",
}
EMPTY_ENERGY = {"(vide)": ""}
ADJUSTMENT = "AJUST"
SALES_CHANNELS = ("B2C", "B2B")

# Accounting headings and the two that pay the dealer network.
HEADINGS = {
    "PROVISION SUR PERTES FUTURES": "Buy Backs",
    "PRIMES VENTES AUX SOCIETES": "B2B promotions",
    "PRIME QUALITE": "Bonus for quality",
    "PRIMES A LA PERFORMANCE RESEAU": "Bonus for dealer performance",
    "PROMOTIONS CLIENT FINAL": "B2C promotions",
}
NETWORK_HEADINGS = ("Bonus for dealer performance", "Bonus for quality")

# Names of the cost rows and reference rows the marts add themselves.
FINANCING = "Financing Costs"
FIXED_MARGIN = "Fixed Margin"
TO_BE_FLAGGED = "To be flagged"
EXEMPT_COUNTRY = "Spain"
SALT = "-VME"


def issued(issuer: str) -> tuple[dict[str, str], tuple[str, ...]]:
    """Heading names and network headings as reports show them, ``issuer - name``."""
    names = {heading: f"{issuer} - {name}" for heading, name in HEADINGS.items()}
    return names, tuple(f"{issuer} - {name}" for name in NETWORK_HEADINGS)
