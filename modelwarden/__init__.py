"""Registry audit and modelling-sample analytics as Spark DataFrame operators."""
