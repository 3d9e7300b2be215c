"""hourcast: Spark-native operators for keyed hourly demand series.

Every operator takes and returns a DataFrame (or a small fitted object whose
``transform`` is a pure plan). Sub-packages:

* ``sources``   -- readers/writers and adapters from the test tables
* ``functions`` -- Column-expression helpers (null/NaN/inf rules, safe maths)
* ``plans``     -- scale primitives: distributed row index, halo windows,
                   blocked fill and blocked prefix sums
* ``operators`` -- cleaning, features, joins, EDA, statistics, scaling,
                   models, evaluation, drift, batch scoring
* ``streaming`` -- Structured Streaming forms of the online path
"""

__version__ = "0.1.0"
