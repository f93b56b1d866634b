"""voxsieve: evidence-driven candidate selection and training-data operators on Spark DataFrames."""
