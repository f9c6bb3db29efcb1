"""hirescope: Spark-native analytics over job postings.

Every public function takes DataFrames (plus small Python parameters) and
returns DataFrames. Heavy work stays on executors; the driver only ever holds
bounded objects (k centroids, a d x d Gram matrix, a lexicon size check).
"""

__version__ = "0.1.0"
