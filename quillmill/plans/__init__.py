"""The four ready pipelines: articles, papers, labelled posts and tweets."""
