"""Training-data operators: dedup, decontamination, mixing, sharding and text models."""
