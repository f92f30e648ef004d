"""signalwatch: spot emerging demand in retail data with Spark DataFrames."""
