"""entigrid: party master-data cleansing, classification and quality on Spark."""

__version__ = "0.1.0"
