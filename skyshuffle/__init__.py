"""skyshuffle: a PySpark-native engine for magnitude-levelled star trees.

The sub-packages are imported explicitly; importing the package itself has no side effects.
"""

__version__ = "0.1.0"
