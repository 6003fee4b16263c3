from rillstone.plans.job import main

main()
