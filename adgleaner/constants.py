"""Results depend on them, so they are stated here as they are."""

# Pages whose text holds one of these are error or empty result pages.
ERROR_PHRASES = (
    "Result not found",
    "No exact matches found",
    "Not found",
    "Item Not found",
    "Search results for:",
)

# The index scan excludes these phrases at the source.
INDEX_EXCLUDED_PHRASES = (
    "Result not found",
    "No exact matches found",
    "Not found",
    "Item Not found",
)

# Candidate labels and sentence template of the zero-shot task.
CANDIDATE_LABELS = (
    "a real animal",
    "a toy",
    "a print of an animal",
    "an object",
    "a faux animal",
    "an animal body part",
    "a faux animal body part",
)
HYPOTHESIS_TEMPLATE = "This product advertisement is about {}."

# Class names of the binary text classifier.
LABEL_CODES = {"LABEL_0": 0, "LABEL_1": 1}

# Country codes that are spelled out; all other locations stay as they are.
COUNTRY_NAMES = {"US": "USA", "GB": "Great Britain"}
