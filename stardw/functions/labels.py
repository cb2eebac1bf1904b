"""Fixed values of the warehouse model: labels, bounds and defaults.

Results are compared on these texts and numbers, so they are stated as they are and in
their natural order.
"""

from datetime import date
from decimal import Decimal

# Age brackets: exclusive upper bound in years -> label; then the open bracket.
AGE_BRACKETS = [(25, "<25"), (35, "25-34"), (45, "35-44"), (55, "45-54"), (65, "55-64")]
AGE_ABOVE = ">=65"
AGE_UNKNOWN = "inconnu"

# Salary brackets: exclusive upper bound -> label; then the open bracket.
SALARY_BRACKETS = [(30000, "<30k"), (50000, "30-50k"), (80000, "50-80k"), (120000, "80-120k")]
SALARY_ABOVE = ">=120k"

# Contract status of an employee.
CONTRACT_NONE = "SansContrat"
CONTRACT_ACTIVE = "Actif"
CONTRACT_EXPIRED = "Expire"
CONTRACT_TYPES = ["CDI", "CDD", "Interim", "Stage", "Alternance", "Freelance"]

# Season by month number.
SEASONS = [("Hiver", [12, 1, 2]), ("Printemps", [3, 4, 5]), ("Été", [6, 7, 8]),
           ("Automne", [9, 10, 11])]

# Price of a product without a price window on the day: cost, selling price.
DEFAULT_COST = Decimal("10.00")
DEFAULT_PRICE = Decimal("20.00")

# High-water mark before the first load, and the usual span of the date dimension.
FIRST_WATERMARK = date(1900, 1, 1)
DATE_DIM_START = date(1997, 1, 1)
DATE_DIM_END = date(2003, 12, 31)

# Discount flag of a sales line.
WITH_DISCOUNT = "avec_remise"
WITHOUT_DISCOUNT = "sans_remise"

# Loyalty card number: this prefix, a dash and eight digits.
CARD_PREFIX = "OSC"

# Longest full name kept.
FULL_NAME_LENGTH = 160

# Seed lists of the operational model.
CONTINENTS = ["Amérique du Nord", "Amérique du Sud", "Europe", "Asie", "Afrique", "Océanie"]
CHANNELS = [(1, "MAGASIN", "Magasin physique"), (2, "CATALOGUE", "Vente par catalogue"),
            (3, "INTERNET", "Vente en ligne")]
DEPARTMENTS = ["Ventes", "Marketing", "Finance", "Informatique", "Ressources Humaines",
               "Logistique"]
SALES_DEPARTMENT = "Ventes"
CUSTOMER_GROUPS = [
    ("Bronze", "Client occasionnel"), ("Argent", "Client régulier"), ("Or", "Client fidèle"),
    ("VIP", "Très haut panier"), ("Inactif", "Pas d'achat depuis plus de 18 mois")]
PRODUCT_LINES = ["Plein air", "Sports collectifs", "Forme & fitness", "Vêtements", "Chaussures"]
PRODUCT_CATEGORIES = [
    ("Plein air", "Camping"), ("Plein air", "Randonnée"), ("Plein air", "Cyclisme"),
    ("Sports collectifs", "Football"), ("Sports collectifs", "Basketball"),
    ("Sports collectifs", "Tennis"), ("Forme & fitness", "Yoga"),
    ("Forme & fitness", "Musculation"), ("Vêtements", "Hommes"), ("Vêtements", "Femmes"),
    ("Chaussures", "Course"), ("Chaussures", "Trail")]
PRODUCT_GROUP_PREFIXES = ["Entrée — ", "Premium — "]
ORG_GROUP_PREFIXES = ["Groupe A — ", "Groupe B — "]
SECTION_PREFIX = "Section "

# Countries: code, name, continent.
COUNTRIES = [
    ("US", "États-Unis", "Amérique du Nord"), ("CA", "Canada", "Amérique du Nord"),
    ("BE", "Belgique", "Europe"), ("NL", "Pays-Bas", "Europe"),
    ("DE", "Allemagne", "Europe"), ("GB", "Royaume-Uni", "Europe"),
    ("DK", "Danemark", "Europe"), ("FR", "France", "Europe"),
    ("IT", "Italie", "Europe"), ("ES", "Espagne", "Europe"),
    ("AU", "Australie", "Océanie"), ("CN", "Chine", "Asie"),
    ("JP", "Japon", "Asie"), ("IN", "Inde", "Asie"),
    ("BR", "Brésil", "Amérique du Sud"), ("ZA", "Afrique du Sud", "Afrique")]
# Countries with a branch of the organisation.
ORG_COUNTRIES = ["Siège USA", "Belgique", "Pays-Bas", "Allemagne", "Royaume-Uni", "Danemark",
                 "France", "Italie", "Espagne", "Australie"]
