"""layercake: layered (stage -> clean -> consumption) analytics pipelines on Spark DataFrames."""
