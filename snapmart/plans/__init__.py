"""Jobs: compositions of operators, from the raw text to the feature and label stores."""
