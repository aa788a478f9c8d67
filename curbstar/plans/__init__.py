"""The datasets: stage 2, the star, its gates, its questions and the whole load."""
