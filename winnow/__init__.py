"""winnow: a Spark-native data-selection engine.

Validates model outputs staged and short-circuiting, removes duplicates
greedily against everything accepted so far (exact keys and embedding
distance), keeps evidence for every verdict and publishes accepted and
rejected datasets.  Everything is DataFrame work planned by Catalyst.
"""

__version__ = "0.1.0"
