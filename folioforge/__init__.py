"""folioforge: a Spark-native engine for collections of semi-structured documents."""
