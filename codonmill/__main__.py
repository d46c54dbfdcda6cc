from codonmill.plans.refresh import main

main()
