"""Junction-safety analytics on Spark: rules, features, evaluation and monitoring as DataFrame operators."""
