"""Fixed values shared by all operators.

Masses are monoisotopic and held as integers in micro-daltons, so sums are
exact and do not depend on the order of summation.
"""

# Monoisotopic residue masses in micro-daltons (published tables).
RESIDUE_MASS = {
    "A": 71037114,
    "C": 103009185,
    "D": 115026943,
    "E": 129042593,
    "F": 147068414,
    "G": 57021464,
    "H": 137058912,
    "I": 113084064,
    "K": 128094963,
    "L": 113084064,
    "M": 131040485,
    "N": 114042927,
    "P": 97052764,
    "Q": 128058578,
    "R": 156101111,
    "S": 87032028,
    "T": 101047679,
    "V": 99068414,
    "W": 186079313,
    "Y": 163063329,
    # as the search parameters list them; B, J, X and Z weigh nothing there and have no entry
    "U": 150953630,
    "O": 132089880,
}
AMINO_ACIDS = "ACDEFGHIKLMNPQRSTVWY"

# Water, proton and C-terminal cleavage masses.
WATER = 18010565
PROTON = 1007276
PROTON_DALTON = 1.00727646688
CLEAVE_C_DALTON = 19.0178

# Static addition on C, variable addition on M.
STATIC_ADDED = {"C": 57021464}
VARIABLE_ADDED = {"M": 15994900}
MAX_VARIABLE_SITES = 3

# Enzyme -> (1 = cuts after / 0 = cuts before, cut residues, residues that block the cut).
ENZYMES = {
    "No_enzyme": (1, AMINO_ACIDS, ""),
    "Trypsin": (1, "KR", "P"),
    "Trypsin/P": (1, "KR", ""),
    "Lys_C": (1, "K", "P"),
    "Lys_N": (0, "K", ""),
    "Arg_C": (1, "R", "P"),
    "Asp_N": (0, "D", ""),
    "CNBr": (1, "M", ""),
    "Glu_C": (1, "DE", "P"),
    "PepsinA": (1, "FL", "P"),
    "Chymotrypsin": (1, "FWYL", "P"),
}

# Search defaults.
MASS_RANGE = (600.0, 5000.0)
LENGTH_RANGE = (4, 40)
MISSED_CLEAVAGES = 2
MASS_TOLERANCE = 3.0
MIN_PEAKS = 10
MAX_PRECURSOR_CHARGE = 6
MAX_FRAGMENT_CHARGE = 3
FRAGMENT_BIN = 1.0005
FRAGMENT_OFFSET = 0.4
NUM_OUTPUT = 5
PROTEINS_PER_BATCH = 2000
SPECTRA_PER_BATCH = 500

# Label prefixes that mark a decoy, and the prefix they become.
DECOY_PREFIXES = ("###REV###", "###RND###", "RND_", "REV_", "REV1_")
DECOY_LABEL = "DECOY_"

# Fixed value: unparsable peak lines tolerated before a read fails.
MAX_BAD_LINES = 2000

# Counter groups whose names are left out of the counter key.
DEFAULT_COUNTER_GROUPS = (
    "org.apache.hadoop.mapred.Task$Counter",
    "org.apache.hadoop.mapred.JobInProgress$Counter",
)
