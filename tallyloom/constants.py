"""Values that must keep their exact spelling for results to agree with existing data.

Nothing here is logic: these are word lists, column names, line labels and character sets.
"""

# Metadata columns of a source file, without the image.
METADATA_COLUMNS = [
    "crop",
    "disease",
    "canonical_disease",
    "plant_organ",
    "visual_symptoms",
    "pathogen",
    "disease_type",
    "symptom_source",
    "symptom_quote",
    "filename",
    "raw_label",
]

# Pointer columns of a manifest row.
FILE_COLUMN = "shard_path"
ORDINAL_COLUMN = "row_idx_in_shard"

# Words that carry no information, compared after trimming and lower-casing.
UNINFORMATIVE = ["", "nan", "none", "null", "undefined", "n/a", "unknown"]

# The characters Unicode counts as white space (U+0009-U+000D, U+001C-U+0020, ...).
WHITESPACE = (
    " "
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000"
    "\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set as a regular-expression class (Java's \s is ASCII only).
SPACE_CLASS = r"[\s\x1c-\x1f\x85\p{Z}]"
# Characters that end a line.
LINE_ENDS = "\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"

# ASCII punctuation.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# Line labels of the answer text, in the order in which they are written.
ANSWER_LABELS = {
    "crop": "Crop",
    "diagnosis": "Diagnosis",
    "disease_type": "Disease type",
    "plant_organ": "Plant organ",
    "visual_symptoms": "Visual symptoms",
    "pathogen": "Pathogen",
}

# Labels under which a field may appear in generated text.
# A blank stands for any run of white space.
FIELD_ALIASES = {
    "diagnosis": ["Diagnosis", "Disease", "Identified Disease", "Canonical Disease"],
    "crop": ["Crop", "Host Crop", "Plant"],
    "disease_type": ["Disease type", "Type"],
    "plant_organ": ["Plant organ", "Organ", "Part"],
    "visual_symptoms": ["Visual symptoms", "Symptoms", "Visual signs"],
    "pathogen": ["Pathogen", "Causal Agent"],
}

# Stand-ins for missing labels.
UNKNOWN = "Unknown"
UNKNOWN_TARGET = "Unknown Disease"

# Fixed value: label that the loss ignores.
IGNORED_LABEL = -100

# Sampling defaults.
SEED = 42
MIN_CLASS_ROWS = 20
MAX_CLASS_ROWS = 400
MAX_TRAIN_ROWS = 200000
VALIDATION_FRACTION = 0.05
TEST_FRACTION = 0.05
# Fixed value: an existing output must be larger than this many bytes to count as finished.
FINISHED_BYTES = 500

# Our own wording; any instruction can be passed instead.
INSTRUCTION = "Look at the photo and name the plant disease it most likely shows."
