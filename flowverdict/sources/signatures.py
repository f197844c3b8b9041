"""The shipped signature catalog: a rule file like any other.

Fixed values: identifiers, names, categories, severities, confidences and conditions decide
the results and must stay exactly as they are, in this order.
"""

from pathlib import Path

SIGNATURE_FILE = Path(__file__).with_name("signatures.json")
