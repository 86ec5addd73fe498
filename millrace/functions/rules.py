"""Word lists, dictionaries and patterns of the item normalizer.

Everything in this module is a FIXED VALUE: results only match if these equal the published ones.
In the pattern texts a plain space stands for "one or more whitespace characters", and every
pattern is matched as whole words, ignoring case.
"""

# --- fixed values: measuring units --------------------------------------------------------------
UNITS = [
    "c", "cup", "cups", "tsp", "teaspoon", "teaspoons", "tbsp", "tablespoon", "tablespoons",
    "oz", "ounce", "ounces", "g", "gram", "grams", "kg", "kgs",
    "ml", "l", "liter", "litre", "liters", "litres", "lb", "pound", "pounds",
    "pt", "pint", "pints", "qt", "quart", "quarts", "gal", "gallon", "gallons",
    "pkg", "pkgs", "package", "packages", "box", "boxes",
]

# --- fixed values: vulgar fractions that count as a number --------------------------------------
FRACTIONS = "¼½¾⅐⅑⅒⅓⅔⅕⅖⅗⅘⅙⅚⅛⅜⅝⅞"

# --- fixed values: characters that become a space -----------------------------------------------
DASHES = r"[-–—•×*/]+"
STOPS = r"[.;:]+"

# --- fixed values: words dropped as a whole token -----------------------------------------------
DESCRIPTORS = [
    "blanched", "roasted", "toasted", "shelled", "unshelled", "cleaned", "washed",
    "rinsed", "dried", "draining", "drained", "thawed", "thaw", "peeled", "unpeeled",
    "seeded", "deseeded", "pitted", "unpitted", "trimmed", "stemmed", "beaten",
    "separated", "divided", "broken", "halved", "quartered", "minced", "chopped",
    "coarsely", "finely", "roughly", "shredded", "sliced", "diced", "crushed",
    "mashed", "grated", "ground", "powdered", "sifted", "melted", "softened",
    "mixed", "stirred", "combined", "whipped", "frozen", "defrosted",
    "prepared", "preheated", "cooked", "uncooked", "baked", "boiled", "fried",
    "sauteed", "sautéed", "steamed", "sterilized", "sterilised", "cubed", "cut up",
    "simmered down from", "cut in inch", "deboned cut in size",
    "large", "larger", "small", "sm", "medium", "md", "med", "tiny", "extra", "extra-large", "pt",
    "very", "thick", "thin", "thinly", "thickly", "whole", "half", "piece", "pieces", "10", "slightly",
    "fresh", "freshly", "ripe", "unripe", "hot", "cold", "warm", "lukewarm", "room",
    "temperature", "cool", "cooling", "chilled", "refrigerated",
    "clove", "cloves", "package", "packages", "pkg", "can", "cans",
    "jar", "bottle", "bag", "packet", "pack", "box", "stick", "sticks",
    "about", "approx", "approximately", "rough", "around", "and", "or", "&",
    "to", "taste", "plus", "more", "only", "as", "needed", "desired", "optional",
    "carefully", "well", "lightly", "heavily", "fully", "firm", "loose", "packed",
    "heaping", "level", "scant", "generous", "new", "flat", "healthy", "pinch",
    "dash", "sprig", "sprigs", "leaf", "leaves", "bunch", "bunches",
    "handful", "handfuls", "slice", "slices", "cube", "cubes", "ring", "rings",
    "drop", "drops",
    "coarse", "bite", "of", "fillet", "brand", "chunk", "container", "cup", "qt", "gal",
]

# --- fixed values: phrases replaced by one space ------------------------------------------------
PHRASES = [
    "to taste",
    "plus more",
    "for (serving|garnish|glaze|basting|brushing)",
    "to (serve|garnish)",
    "for (the )?(dressing|sauce)",
    "cut into (inch )?(pieces?|wedges?|strips?|chunks?|slices?)",
    "cored and cut into",
    "cut lengthwise",
    "cut crosswise",
    "trimmed and (cut|chopped)",
    "chopped and (drained|rinsed)",
    "peeled and (chopped|sliced|diced)",
    "deseeded and",
    "drained and rinsed",
    "thawed and drained",
    r"carefully washed,\s*dried and",
    "washed and dried",
    "blanched and peeled",
    "heaping tablespoons?",
    "heaping teaspoons?",
    "scant cup",
    "to cover",
    "juice only",
    "zest only",
    "pitted (and )?chopped",
    "roasted and shelled",
    "ground and toasted",
    "i like peel mine",
    "healthy pinch",
    "dash of",
]

# --- fixed values: brand names that are deleted -------------------------------------------------
BRANDS = [
    "white lily",
    "eagle brand",
    "campbell[’']?s?",
    "smucker[’']?s?",
    "chicken of the sea",
    "betty cro(?:cker)?",
    r"jell[-\s]?o",
    "velveeta",
    "philadelphia",
]

# --- fixed values: two nouns run together -> "first or second" ----------------------------------
STUCK_PAIRS = [
    ("butter", "margarine"),
    ("oil", "shortening"),
    ("sugar", "honey"),
    ("chocolate", "cocoa"),
    ("vinegar", "lemon juice"),
    ("cream", "milk"),
    ("cashew", "peanut"),
    ("flounder", "pollack fillet"),
]
# This prefix goes together with the whitespace after it, between the last two pairs above.
STUCK_PREFIX = "white lily"

# --- fixed values: misreadings and abbreviations, applied in this order -------------------------
MISREADINGS = [
    (r"e\s*tract", "extract"),
    ("creme de cocoa", "creme de cacao"),
    ("pcz", "pcs"),
    ("mi", "mix"),
    (r"low\s*fat", "lowfat"),
]

# --- fixed values: one more rewrite, only inside the normalizer ---------------------------------
TEN_X = (r"10\s*[x×\-]?\s*sugar", "powdered sugar")

# --- fixed values: spelling of a whole normalized item ------------------------------------------
SPELLING = {
    "margerine": "margarine",
    "margerines": "margarine",
    "margerin": "margarine",
    "confectioners sugar": "confectioners' sugar",
}

# --- fixed values: preferred name of a whole normalized item, after the spelling ----------------
ALIASES = {
    "soft margarine": "margarine",
    "stick margarine": "margarine",
    "butter margarine": "margarine",
    "block margarine": "margarine",
    "chicken style": "chicken style seasoning",
    "chicken": "chicken breast",
    "10x sugar": "powdered sugar",
    "10-x sugar": "powdered sugar",
    "10 × sugar": "powdered sugar",
    "lean pork chop": "pork chop",
    "doz okra": "okra",
    "feet": "pig feet",
    "bottled low calorie italian salad dressing": "italian salad dressing",
    "egg": "eggs",
    "egg white": "egg whites",
    "hard egg": "eggs",
    "bottl lemon lime soda": "lemon lime soda",
    "bottl ginger ale": "ginger ale",
    "icing sugar": "powdered sugar",
    "confectioners' sugar": "powdered sugar",
    "noodl": "noodles",
    "chinese noodl": "noodles",
    "vegetabl": "vegetables",
    "qt milk": "milk",
    "nut": "nuts",
    "potat": "potatoes",
    "commercial barbecue sauce": "barbecue sauce",
}

# --- fixed values: plural endings that stay although they end in "es" or "s" --------------------
KEEP_ES = ["ses", "xes", "zes", "ches", "shes"]
KEEP_S = ["ss", "us"]

# --- fixed values: special tokens; the position is the id ---------------------------------------
SPECIALS = ["[PAD]", "[BOS]", "[EOS]", "[UNK]", "<ING>", "<REC>", "<TITLE>", "<STEP>"]
PAD, BOS, EOS, UNK = 0, 1, 2, 3
IGNORED_TARGET = -100
