"""corpusloom: a Spark-native engine for preparing and analysing language-model corpora."""
