"""DataFrame-to-DataFrame operators shared by the models, the checks and the profile."""
