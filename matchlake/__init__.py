"""Match, event and lineup analytics as Spark DataFrame transformations.

``functions`` holds column expressions, ``operators`` DataFrame steps,
``sources`` readers and table writers, ``plans`` the layer pipelines
(bronze history, silver current state, gold marts).
"""
