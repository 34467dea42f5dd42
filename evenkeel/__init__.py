"""evenkeel: balanced, de-duplicated, stratified labelled-text corpora built with Spark."""
