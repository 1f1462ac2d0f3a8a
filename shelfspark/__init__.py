"""shelfspark: a Spark-native engine for nested media-list documents.

Documents (one user's lists of entries, each entry embedding its media) are
validated, flattened into a fact table and two dimensions, joined into a wide
score mart with lockstep-unnested arrays, and queried (distinct score counts,
top-k genres/tags per score, quality checks, topic fan-out, clustering).
Every step is a DataFrame -> DataFrame function; nothing is collected to the
driver on the data path.
"""

__version__ = "0.1.0"
